"""Schemas of everything the pipeline keeps, one per entity."""

from __future__ import annotations

from pyspark.sql.types import StructType

_IMAGE = "filename string, original_filename string, path string, context_before string, context_after string"
_SEGMENT = "text string, distance int, is_heading boolean, heading_level int"
_TEXTS = {
    "space": "space_id string, name string, description string",
    "node": "node_token string, parent_node_token string, obj_token string, obj_type string, title string, space_id string, obj_edit_time string, depth int",
    "entry": "token string, doc_type string, ext string, name string, url string, space_id string, obj_edit_time string",
    "download": "token string, downloaded_at timestamp, file_path string, obj_edit_time string, name string, space_id string, source_url string",
    "element": "doc_name string, elem_idx int, elem_type string, content string, has_image boolean, is_heading boolean, heading_level int",
    "page": "doc_name string, page_num int, text string, images array<struct<xref:int,ext:string>>, text_blocks array<struct<text:string,font_size:double>>",
    "segment": f"{_SEGMENT}, font_size double",
    "image": f"page_number int, image_index int, position int, context_before string, context_after string, original_filename string, smart_filename string, context_segments_before array<struct<{_SEGMENT.replace(' ', ':').replace(',:', ',')}>>, context_segments_after array<struct<{_SEGMENT.replace(' ', ':').replace(',:', ',')}>>",
    "chunk": "chunk_id string, chunk_index int, content string, char_count int, page_number int, metadata map<string,string>",
    "document": "filename string, format string, total_pages int, total_chunks int, total_images int, created_at string, output_dir string",
    "embedding": "chunk_index int, embedding array<float>, model string, created_at timestamp",
    "chunk_metadata": f"id string, doc_name string, timestamp string, chunk_index int, metadata struct<source:string,chunk_id:string,chunk_index:int,char_count:int,doc_format:string,doc_timestamp:string,processed_at:string,has_images:boolean,image_count:int,images:array<struct<{_IMAGE.replace(' ', ':').replace(',:', ',')}>>>",
    "doc_chunks": "id bigint, doc_name string, doc_format string, doc_timestamp string, chunk_id string, chunk_index int, chunk_text string, char_count int, page_number int, has_images boolean, image_count int, images_json string, source_file string, space_id string, source_url string, embedding array<float>, processed_at string, created_at timestamp, updated_at timestamp",
    "entity": "entity_name string, entity_type string, description string, source_doc string, source_chunk_id string, embedding array<float>, batch_timestamp string, created_at timestamp",
    "relation": "source_entity string, target_entity string, relation_type string, description string, weight double, source_doc string, batch_timestamp string, created_at timestamp",
    "graph_chunk": "chunk_id string, doc_name string, content string, token_count int, chunk_order int, full_doc_id string, batch_timestamp string, created_at timestamp",
    "graph_manifest": "doc_name string, hash string, built_at timestamp",
    "sheet": "file_name string, file_stem string, sheet_count int, extracted_sheets int, sheets array<struct<sheet_name:string,field_count:int,fields:array<struct<index:int,name:string,description:string,data_type:string>>>>",
    "result": "document string, doc_path string, batch_timestamp string, error string, success boolean, skipped boolean, chunks int, images int, duration_seconds double",
    "readiness": "status string, completed_at timestamp, pid int, summary map<string,string>",
    "lock": "pid int, start_time timestamp",
    "model": "model_name string, embedding_dim int, pooling_mode string, normalize boolean, max_length int, exported_from string",
}


def schema(entity: str) -> StructType:
    return StructType.fromDDL(_TEXTS[entity])


ENTITIES = tuple(_TEXTS)

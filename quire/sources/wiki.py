"""Spaces and nodes of a wiki as export entries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quire.functions import text as T
from quire.plans.retry import retried


def exportable(nodes: DataFrame, types: dict[str, str] = T.EXPORTS) -> DataFrame:
    """Nodes of a type that can be exported, with its file format."""
    ext = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return nodes.filter(F.col("obj_type").isin(*types)).withColumn("ext", ext[F.col("obj_type")])


def discovered(nodes: DataFrame, resolved_titles: DataFrame | None = None, types: dict[str, str] = T.EXPORTS) -> DataFrame:
    """Export entries of all nodes that can be exported and have a title, looked up where the node has none."""
    n = exportable(nodes, types)
    if resolved_titles is not None:
        n = n.join(resolved_titles.select("node_token", F.col("title").alias("_title")), "node_token", "left")
        n = n.withColumn("title", F.when(F.coalesce("title", F.lit("")) == "", F.col("_title")).otherwise(F.col("title")))
    return n.filter(~T.blank("title")).select(
        F.col("obj_token").alias("token"), F.col("obj_type").alias("doc_type"), "ext", F.col("title").alias("name"),
        F.concat(F.lit("wiki_node:"), "node_token").alias("url"), "space_id", F.coalesce("obj_edit_time", F.lit("")).alias("obj_edit_time"),
    )


def skipped(nodes: DataFrame, types: dict[str, str] = T.EXPORTS) -> DataFrame:
    """How many nodes discovery leaves out, by type, or as untitled."""
    kept = F.coalesce(F.col("obj_type").isin(*types), F.lit(False))
    reason = F.when(kept, "untitled").otherwise(F.col("obj_type"))
    return nodes.filter(~kept | T.blank("title")).groupBy(reason.alias("reason")).agg(F.count("*").alias("skipped"))


def resolved(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """asked (node_token ...) with obj_token, obj_type and title of the node; nulls for an unknown one."""
    return asked.join(nodes.select("node_token", "obj_token", "obj_type", "title").distinct(), "node_token", "left")


def entries(urls: DataFrame, url: str, default_ext: str = "docx") -> DataFrame:
    """Export entries of the addresses that can be read; the others are dropped."""
    p = urls.select(F.col(url).alias("url"), T.address_parts(url).alias("p")).filter("p is not null")
    return p.select("p.token", "p.doc_type", F.coalesce(F.nullif("p.ext", F.lit("")), F.lit(default_ext)).alias("ext"), "url")


def url_list(lists: DataFrame, urls: str) -> DataFrame:
    """One row per address of comma-separated lists."""
    return lists.select(F.explode(F.split(urls, ",")).alias("url")).select(F.trim("url").alias("url")).filter("url <> ''")


def from_list(spark: SparkSession, documents: list[dict[str, str]]) -> DataFrame:
    """Entries of a list as it stands in a configuration file: url, and name and ext where given."""
    rows = [(d.get("url", ""), d.get("name"), d.get("ext") or None) for d in documents]
    df = spark.createDataFrame(rows, "url string, name string, ext string")
    p = df.withColumn("p", T.address_parts("url")).filter("p is not null")
    return p.select("p.token", "p.doc_type", F.coalesce("ext", "p.ext").alias("ext"), "name", "url")


Listing = Callable[[str, str | None], tuple[list[tuple], str | None]]


def paged(client: Listing, as_name: str = "wiki_pages", spaces: Callable[[str | None], tuple[list[str], str | None]] | None = None) -> type[DataSource]:
    """A paged listing as a data source to register; client(space, cursor) gives rows and the next cursor.

    The option `spaces` names the spaces, else spaces(cursor) lists them, page by page.  Each space is one partition and
    reads its pages until there is no cursor; a page is asked for again after errors of the connection.
    """

    class Pages(DataSource):
        @classmethod
        def name(cls) -> str:
            return as_name

        def schema(self) -> str:
            return "node_token string, parent_node_token string, obj_token string, obj_type string, title string, space_id string, obj_edit_time string"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            named = self.options.get("spaces")
            if named is None and spaces is None:
                raise ValueError("spaces must be named or listed")
            return _PageReader(client, named.split(",") if named is not None else list(pages(spaces)))

    return Pages


def pages(ask: Callable[[str | None], tuple[list, str | None]]) -> Iterator:
    """All rows of a listing that is read cursor by cursor."""
    cursor = None
    while True:
        rows, cursor = retried(lambda c=cursor: ask(c))
        yield from rows
        if not cursor:
            return


class _PageReader(DataSourceReader):
    def __init__(self, client: Listing, spaces: list[str]) -> None:
        self.client, self.spaces = client, spaces

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(s) for s in self.spaces]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return pages(lambda cursor: self.client(partition.value, cursor))

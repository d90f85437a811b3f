"""Vectors for texts through a model that each worker loads once."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

Model = Callable[[list[str]], np.ndarray]


def hashing_model(dims: int = 512) -> Model:
    """A stand-in without a model file: character trigrams hashed to `dims` signed buckets."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims), dtype=np.float32)
        for i, t in enumerate(texts):
            for k in range(len(t) - 2):
                h = zlib.crc32(t[k : k + 3].encode())
                out[i, h % dims] += 1 if h >> 31 else -1
        return out

    return embed


def onnx_model(path: str, tokenizer: str, pooling: str = "cls", length: int = 512, threads: int = 1) -> Callable[[], Model]:
    """A loader for an exported encoder: first-token or mean pooling over the mask, one thread per worker."""

    def load() -> Model:
        import onnxruntime as ort
        from tokenizers import Tokenizer

        options = ort.SessionOptions()
        options.intra_op_num_threads = options.inter_op_num_threads = threads
        session = ort.InferenceSession(path, options, providers=["CPUExecutionProvider"])
        words = Tokenizer.from_file(tokenizer)
        words.enable_truncation(length)
        words.enable_padding()
        names = {i.name for i in session.get_inputs()}

        def embed(texts: list[str]) -> np.ndarray:
            enc = words.encode_batch(texts)
            feed = {
                "input_ids": np.array([e.ids for e in enc], dtype=np.int64),
                "attention_mask": np.array([e.attention_mask for e in enc], dtype=np.int64),
                "token_type_ids": np.array([e.type_ids for e in enc], dtype=np.int64),
            }
            hidden = session.run(None, {k: v for k, v in feed.items() if k in names})[0]
            if pooling == "cls":
                return hidden[:, 0]
            mask = feed["attention_mask"][:, :, None].astype(np.float32)
            return (hidden * mask).sum(axis=1) / np.clip(mask.sum(axis=1), 1e-9, None)

        return embed

    return load


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.clip(np.linalg.norm(x, axis=1, keepdims=True), 1e-12, None)


def embedded(rows: DataFrame, text: str, load: Callable[[], Model] = hashing_model, batch: int = 16, out: str = "embedding", stop: bool = False) -> DataFrame:
    """rows with unit vectors of their texts; null for null and blank ones, and for a batch that the model fails on.
    stop: a task asks the model no more after a failure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, broken = load(), False
        for b in batches:
            vectors: list[list[float] | None] = [None] * len(b)
            full = [i for i, t in enumerate(b[text]) if isinstance(t, str) and t.strip()]
            for k in range(0, len(full), batch):
                some = full[k : k + batch]
                if broken and stop:
                    break
                try:
                    found = unit_rows(model([b[text].iloc[i] for i in some]))
                except Exception:  # noqa: BLE001
                    broken = True
                    continue
                for i, v in zip(some, found):
                    vectors[i] = v.tolist()
            yield b.assign(**{out: vectors})

    kept = [f for f in rows.schema.fields if f.name != out]
    return rows.select(*[f.name for f in kept]).mapInPandas(run, StructType([*kept, StructField(out, ArrayType(FloatType()))]))

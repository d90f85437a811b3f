"""Options of a run.  Secrets come from the environment alone and are never written or logged."""

from __future__ import annotations

import dataclasses
import os
from pathlib import Path
from typing import Any

from quire.core import splitting, tidying


@dataclasses.dataclass(frozen=True)
class Options:
    """Every option is used by some stage.  Defaults are the values in production."""

    chunk_size: int = splitting.SIZE
    chunk_overlap: int = splitting.OVERLAP
    image_name_length: int = tidying.NAME_LENGTH
    context_length: int = 600
    look_back: int = 8
    look_ahead: int = 5
    embedding_batch: int = 16
    entity_batch: int = 32
    dims: int = 512
    graph_window: int = 1500
    graph_overlap: int = 200
    force_rebuild: bool = False
    legacy_doc_format: bool = False

    @classmethod
    def load(cls, path: str | os.PathLike | None = None, **more: Any) -> Options:
        """Options from a YAML file of known names, if there is one, then from arguments.  Unknown names raise."""
        values: dict[str, Any] = {}
        if path and Path(path).exists():
            import yaml

            values |= yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
        values |= more
        unknown = set(values) - {f.name for f in dataclasses.fields(cls)}
        if unknown:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        return cls(**values)


def secret(name: str) -> str | None:
    return os.environ.get(f"QUIRE_{name.upper()}")

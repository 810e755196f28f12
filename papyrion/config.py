"""Settings of a run, with the defaults of the document pipeline."""

from __future__ import annotations

from dataclasses import dataclass, field

from papyrion.operators.chunking import ChunkingConfig


@dataclass(frozen=True)
class ExtractionConfig:
    pattern: str = "*.pdf"
    primary: str = "pdf"
    fallback: str = "text"
    #: Plain text files (``pattern``), read in parts whatever their size; ``primary`` and ``fallback`` are not used.
    in_parts: bool = False


@dataclass(frozen=True)
class PipelineConfig:
    version: str = "1.0.0"
    min_quality_score: float = 50.0
    embedding_dim: int = 64
    as_of: str = "1970-01-01 00:00:00"
    #: Types of chunks by ``chunk_classes``, learned from the chunks of the run itself; else by the rules alone.
    learned_types: bool = False
    extraction: ExtractionConfig = field(default_factory=ExtractionConfig)
    chunking: ChunkingConfig = field(default_factory=ChunkingConfig)


def from_mapping(given: dict) -> PipelineConfig:
    """Settings from a nested mapping such as a parsed YAML file; unknown keys are ignored."""
    take = lambda cls, d: cls(**{k: d[k] for k in cls.__dataclass_fields__ if k in d})
    chunking, extraction = given.get("chunking", {}), given.get("extraction", {}).get("pdf", {})
    names = {"chunk_size": "size", "chunk_overlap": "overlap", "min_chunk_size": "min_size", "max_chunk_size": "max_size", "primary_method": "primary", "fallback_method": "fallback", "read_in_parts": "in_parts"}
    rename = lambda d: {names.get(k, k): v for k, v in d.items()}
    out = {k: given[k] for k in ("version", "min_quality_score", "embedding_dim", "as_of", "learned_types") if k in given}
    if "min_quality_score" in given.get("validation", {}):
        out["min_quality_score"] = given["validation"]["min_quality_score"]
    return PipelineConfig(**out, chunking=take(ChunkingConfig, rename(chunking)), extraction=take(ExtractionConfig, rename(extraction)))


def load(path: str) -> PipelineConfig:
    """Settings from a YAML file; defaults where there is none."""
    import os

    if not os.path.exists(path):
        return PipelineConfig()
    import yaml

    with open(path, encoding="utf-8") as f:
        return from_mapping(yaml.safe_load(f) or {})

"""Options of a run."""

from __future__ import annotations

from dataclasses import asdict, dataclass


@dataclass
class Config:
    """What a run can be told; fields and defaults are those of the library users switch from."""

    book_id: str = ""
    base_url: str = "http://localhost:8000/v1"
    api_key: str = "EMPTY"
    processing_model: str = ""
    validation_model: str = ""
    cache_dir: str = "./cache"
    output_file: str | None = None
    chunk_size: int = 1000
    chunk_overlap: int = 150
    max_retries: int = 3
    verbose: bool = False
    no_critic: bool = False
    force_stage: int | None = None
    chapters_only: list[int] | None = None
    include_front_matter: bool = False
    include_back_matter: bool = False

    def __post_init__(self) -> None:
        self.validation_model = self.validation_model or self.processing_model

    def stage_path(self, stage: int) -> str:
        names = {1: "download", 2: "discovery", 3: "chapters", 4: "characters", 5: "segments", 6: "critic", 7: "final"}
        return f"{self.cache_dir.rstrip('/')}/{stage:02d}-{names[stage]}"

    def must_run(self, stage: int, complete: bool) -> bool:
        """Whether a stage has to be done: from the forced stage on always, assembly always, else if it is not complete."""
        return stage == 7 or not complete or (self.force_stage is not None and self.force_stage <= stage)

    def processing_config(self) -> dict:
        keys = ("processing_model", "validation_model", "chunk_size", "chunk_overlap")
        return {k: v for k, v in asdict(self).items() if k in keys} | {"dual_llm_validation": self.processing_model != self.validation_model}


def chapter_list(text: str | None) -> list[int] | None:
    """``1,3-5`` as numbers; raises ValueError on anything else."""
    if not text:
        return None
    out: list[int] = []
    for part in text.split(","):
        lo, _, hi = part.strip().partition("-")
        out += range(int(lo), int(hi or lo) + 1)
    return sorted(set(out))

"""The options of the command line."""

from __future__ import annotations

import argparse
import sys

from quillspark.plans.config import Config, chapter_list


def parsed_arguments(argv: list[str] | None = None) -> tuple[Config, str]:
    """The configuration and the folder of books; a bad chapter list raises ValueError."""
    p = argparse.ArgumentParser(prog="quillspark", description="Turn plain-text books into structured documents.")
    p.add_argument("source", help="a folder of text files, one per book")
    p.add_argument("--book-id", default="")
    p.add_argument("--model", default="", help="processing model; without one only the deterministic tiers run")
    p.add_argument("--validator", default="", help="validation model, by default the processing model")
    p.add_argument("--base-url", default=Config.base_url)
    p.add_argument("--api-key", default=Config.api_key)
    p.add_argument("--cache-dir", default=Config.cache_dir)
    p.add_argument("--output", default=None)
    p.add_argument("--chunk-size", type=int, default=Config.chunk_size)
    p.add_argument("--overlap", type=int, default=Config.chunk_overlap)
    p.add_argument("--critic", action=argparse.BooleanOptionalAction, default=False)
    p.add_argument("--include-front-matter", action="store_true")
    p.add_argument("--include-back-matter", action="store_true")
    p.add_argument("--force-stage", type=int, default=None)
    p.add_argument("--chapters", default=None, help="such as 1,3-5")
    p.add_argument("--max-retries", type=int, default=Config.max_retries)
    p.add_argument("--verbose", action="store_true")
    a = p.parse_args(argv)
    config = Config(
        book_id=a.book_id, base_url=a.base_url, api_key=a.api_key, processing_model=a.model, validation_model=a.validator, cache_dir=a.cache_dir, output_file=a.output,
        chunk_size=a.chunk_size, chunk_overlap=a.overlap, max_retries=a.max_retries, verbose=a.verbose, no_critic=not a.critic, force_stage=a.force_stage,
        chapters_only=chapter_list(a.chapters), include_front_matter=a.include_front_matter, include_back_matter=a.include_back_matter,
    )
    return config, a.source


if __name__ == "__main__":
    from quillspark.plans.pipeline import main

    sys.exit(main())

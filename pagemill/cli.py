"""The command line: `python -m pagemill SOURCE`.  Options override settings files, those the defaults; errors of use are one line."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from .api import run_extraction
from .config import REFINE_MODES, VISUAL_MODES, load
from .operators.artifacts import STAGES

#: Options that set a setting: name, section, key, type.
_SETTINGS = (
    ("--output-dir", "runtime", "output_dir", str), ("--dpi", "runtime", "dpi", int), ("--start-page", "runtime", "start_page", int), ("--end-page", "runtime", "end_page", int), ("--refine-mode", "runtime", "refine_mode", str),
    ("--base-url", "models", "base_url", str), ("--model", "models", "model", str), ("--triage-model", "models", "triage_model", str), ("--triage-num-predict", "models", "triage_num_predict", int),
    ("--triage-confidence", "models", "triage_confidence", float), ("--photo-skip-confidence", "models", "photo_skip_confidence", float), ("--temperature", "models", "temperature", float), ("--num-ctx", "models", "num_ctx", int),
    ("--num-predict", "models", "num_predict", int), ("--vlm-concurrency", "models", "vlm_concurrency", int), ("--vlm-page-image-max-px", "models", "vlm_page_image_max_px", int), ("--ca-bundle", "models", "ca_bundle", str),
)
#: Flags: name, section, key, value.
_FLAGS = (
    ("--skip-vlm", "runtime", "skip_vlm", True), ("--skip-picture-triage", "runtime", "skip_picture_triage", True), ("--photo-summaries", "runtime", "photo_summaries", True), ("--no-divider-reorder", "runtime", "divider_reorder", False),
    ("--auto-num-ctx", "models", "auto_num_ctx", True),
)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pagemill", description="Pages of a source as Markdown, blocks and records.")
    p.add_argument("source", help="table of items or of web pages (Parquet or JSON)")
    p.add_argument("--config", action="append", default=[], help="YAML file of settings; may be given more than once")
    p.add_argument("--visual-values-mode", choices=VISUAL_MODES, default="off")
    p.add_argument("--resume-from", choices=STAGES[1:], help="restart saved pages at this stage")
    p.add_argument("--shard", action="store_true", help="name run files after the range of pages")
    p.add_argument("--prompt-file", help="prompt of the refinement in place of the own one")
    for name, section, key, kind in _SETTINGS:
        p.add_argument(name, dest=f"{section}.{key}", type=kind, choices=REFINE_MODES if key == "refine_mode" else None)
    for name, section, key, value in _FLAGS:
        p.add_argument(name, dest=f"{section}.{key}", action="store_const", const=value)
    return p


def settings(args: argparse.Namespace, environment=None):
    """Settings of a command: files, then the environment, then options that were given."""
    from dataclasses import asdict

    base = load(*args.config, environment=environment)
    over: dict[str, dict] = {}
    for name, value in vars(args).items():
        if "." in name and value is not None:
            section, key = name.split(".")
            over.setdefault(section, {})[key] = value
    return load(asdict(base), over, environment={})


def run(argv: Sequence[str] | None = None, spark=None) -> int:
    """Run a command; 1 and a line on the error stream where its use is wrong."""
    try:
        args = parser().parse_args(argv)
        config = settings(args)
        if args.prompt_file:
            from .prompts import load as prompt

            prompt("page_refine", args.prompt_file)
        if spark is None:
            from pyspark.sql import SparkSession

            spark = SparkSession.builder.appName("pagemill").getOrCreate()
        factory = None
        if config.models.base_url and not config.runtime.skip_vlm:
            from .operators.client import chat_client

            m = config.models
            factory = chat_client(m.base_url, m.model, temperature=m.temperature, num_ctx=m.num_ctx, num_predict=m.num_predict, auto_num_ctx=m.auto_num_ctx, certificates=m.ca_bundle)
        return run_extraction(spark, args.source, config=config, visual_values_mode=args.visual_values_mode, resume_from=args.resume_from, shard=args.shard, model=factory)
    except (ValueError, FileNotFoundError, RuntimeError) as e:
        print(f"error: {str(e).splitlines()[0] if str(e) else type(e).__name__}", file=sys.stderr)
        return 1


def main() -> None:
    sys.exit(run())

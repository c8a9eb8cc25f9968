"""A run as one call: pages of a source through order, furniture, Markdown plan and model stages, to states, outputs and a run record.

The source is a table of items (doc, page, pos, kind, level, band, text) or of web pages (page_id, url, html).  Reading other
files into items is a converter's business; none ships with this engine."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import prompts as pr
from .config import VISUAL_MODES, Config, load
from .operators import furniture as fu
from .operators import gates as ga
from .operators import model as mo
from .operators import state as st
from .operators.artifacts import STAGES
from .plans.postprocess import postprocess
from .sources import files, html


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """Items of a source: a Parquet or JSON table of items or of web pages."""
    if path.lower().endswith(".pdf"):
        raise RuntimeError("no converter for PDF files is installed; give a table of items or of web pages")
    table = spark.read.json(path) if path.lower().endswith((".json", ".jsonl")) else spark.read.parquet(path)
    if {"doc", "page", "pos", "kind", "text"} <= set(table.columns):
        return table
    if {"page_id", "url", "html"} <= set(table.columns):
        return html.items(table)
    raise ValueError(f"{path} holds neither items nor web pages")


def checked(config: Config, visual_mode: str = "off", resume_from: str | None = None) -> Config:
    """The settings of a run, if they make sense together."""
    if visual_mode not in VISUAL_MODES:
        raise ValueError(f"the mode of visual values must be one of {', '.join(VISUAL_MODES)}")
    if config.models.vlm_concurrency < 1:
        raise ValueError("at least one call at a time is needed")
    if resume_from is not None and resume_from not in STAGES[1:]:
        raise ValueError(f"a replay starts at one of {', '.join(STAGES[1:])}")
    return config


def refined(pages: DataFrame, config: Config, factory: Callable | None) -> tuple[DataFrame, DataFrame]:
    """(pages with `markdown`, calls): raw pages that are not plain prose go through the model; others, and all without one, stay."""
    none = pages.sparkSession.createDataFrame([], "key string, answer string, attempts int, prompt_tokens int, output_tokens int, error string")
    if factory is None or config.runtime.skip_vlm:
        return pages.withColumn("markdown", F.col("raw")), none
    template = pr.load("page_refine")
    plain = ga.is_plain_prose(F.col("raw"), F.lit(0), F.lit(0), F.contains("raw", F.lit("\n|")), F.lit(False)) & F.lit(config.runtime.refine_mode == "auto")
    asked = pages.where(~plain).select(F.concat_ws("/", "doc", "page").alias("key"), F.lit(template).alias("t"), "raw")
    prompt = F.replace(F.replace(F.replace(F.col("t"), F.lit("{layout_blocks}"), F.lit("[]")), F.lit("{verified_tables}"), F.lit("(none)")), F.lit("{source_markdown}"), F.col("raw"))
    calls = mo.call_model(asked.select("key", prompt.alias("prompt")), factory, key="key")
    met = pages.withColumn("key", F.concat_ws("/", "doc", "page")).join(calls.select("key", "answer"), "key", "left")
    return met.withColumn("markdown", F.coalesce(F.nullif("answer", F.lit("")), "raw")).drop("answer", "key"), calls


def run_extraction(
    spark: SparkSession, source: str, *, config: Config | None = None, config_files: tuple[str, ...] = (), start_page: int | None = None, end_page: int | None = None, output_dir: str | None = None, skip_vlm: bool | None = None,
    visual_values_mode: str = "off", refine_mode: str | None = None, resume_from: str | None = None, shard: bool = False, model: Callable | None = None,
) -> int:
    """Run a source and write its outputs; 0 if every page came out, else 1.  None falls back to the settings.

    Nothing of a run is global, so runs with other settings may go on beside it.  With `resume_from`, saved pages restart at that
    stage: what it and later stages own is cleared, and pages that are not saved are left alone."""
    over = {"runtime": {k: v for k, v in (("start_page", start_page), ("end_page", end_page), ("output_dir", output_dir), ("skip_vlm", skip_vlm), ("refine_mode", refine_mode)) if v is not None}}
    c = checked(load(*config_files, over) if config is None else load(_as_mapping(config), over, environment={}), visual_values_mode, resume_from)
    out = c.runtime.output_dir.rstrip("/")
    items = files.select_pages(read_source(spark, source), c.runtime.start_page, c.runtime.end_page)
    pages = items.select("doc", "page").distinct()
    if resume_from is not None:
        saved, _ = st.load(spark, f"{out}/pages")
        kept = st.invalidated(saved, F.lit(resume_from))
        items = items.join(kept.select("page"), "page", "left_semi")
        pages = pages.join(kept.select("page"), "page", "left_semi")
    kept = fu.split_furniture(items, pages).where("not furniture")
    raw = html.page_markdown(items).withColumnRenamed("markdown", "raw")
    body = html.page_markdown(kept).withColumnRenamed("markdown", "body")
    page_texts = raw.join(body, ["doc", "page"], "left").select("doc", "page", F.coalesce("body", F.lit("")).alias("raw"))
    texts, calls = refined(page_texts, c, model)
    final = postprocess(texts.select("doc", "page", "raw", "markdown"), fu.strip_texts(items, pages))
    now = datetime.now(UTC)
    first = final.select(F.element_at(F.split("doc", "/"), -1).alias("pdf_name"), F.lit(0).alias("pdf_size"), "page", F.col("page").alias("page_index"), F.lit(c.runtime.dpi).alias("dpi"))
    done = first.withColumn("total_pages", F.lit(0)).join(final.select("page", "raw", "markdown", "final", F.transform_values("warnings", lambda _, v: v.cast("string")).alias("found")), "page")
    states = st.new_states(done.select("pdf_name", "pdf_size", "page", "page_index", "dpi", "total_pages", F.col("raw").alias("raw_markdown"), F.col("markdown").alias("refined_markdown"), F.col("final").alias("final_markdown"), F.col("found").alias("warnings")))
    none = F.lit(None).cast("string")
    details = F.create_map().cast("map<string,string>")
    for stage in ("prepare", "page_refine", "finalize"):
        states = st.with_record(states, F.lit(stage), F.lit("ok"), F.lit(0.0), details, none, none, F.lit(now.timestamp()))
    st.save(states, f"{out}/pages")
    saved, _ = st.load(spark, f"{out}/pages")
    current = saved.join(pages.select("page").distinct(), "page", "left_semi")
    wrote = st.write_run(current, out, html.block_rows(items).withColumnRenamed("doc", "source"), shard=shard)
    bad = st.failed(current).count()
    if wrote and not shard:
        stale = saved.join(pages.select("page").distinct(), "page", "left_anti").select(st.page_dir(F.col("page")).alias("page_dir"))
        count = saved.agg(F.max("page")).first()[0]
        record = st.run_record(current, {"filename": source.rstrip("/").split("/")[-1], "sha256": _digest(items), "page_count": count}, {"refine_mode": c.runtime.refine_mode, "visual_values_mode": visual_values_mode}, {"page_refine": pr.load("page_refine")}, stale, now.isoformat(timespec="seconds"))
        spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{out}/run")
        st.write_all(spark, f"{out}/pages", out)
    del calls
    return 1 if bad or not wrote else 0


def _digest(items: DataFrame) -> str:
    """A digest of a source's items, whatever their order."""
    import hashlib

    total = items.agg(F.count("*"), F.sum(F.xxhash64("doc", "page", "pos", "text").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr(tuple(map(str, total))).encode()).hexdigest()


def _as_mapping(config: Config) -> dict:
    from dataclasses import asdict

    return asdict(config)

"""Pages of a run as records: their state, what a replay clears, progress events, run record and outputs.

A page is a row, a stage appends to its history, and a checkpoint is the row itself: written by Spark's committer, read with a
declared schema, so fields of other versions never get in."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import contracts as co
from .artifacts import STAGES
from .gates import RECONSTRUCTION_VERSION, SCHEMA_VERSION
from .tagged import COLLECTOR_VERSION

RECORD = "struct<stage:string,status:string,elapsed_seconds:double,details:map<string,string>,error_type:string,error_message:string,recorded_at:double>"
PICTURE = (
    "struct<page:int,index:int,placeholder:string,rel_path:string,abs_path:string,classification:string,caption:string,norm_rect:array<double>,area_ratio:double,summarize:boolean,skip_reason:string,triage_eligible:boolean,"
    "triage_type:string,triage_confidence:double,triage_action:string,triage_warnings:array<string>,triage_usage:map<string,string>,summary:string,summary_type:string,summary_warnings:array<string>,"
    "summary_redundant:boolean,usage:map<string,string>,embedded_in:string,embed_overlap_ratio:double>"
)
CANDIDATE = (
    "struct<candidate_id:string,kind:string,bbox:array<double>,source_block_ids:array<string>,picture_index:int,confidence:double,reason:string,markdown:string,verified:boolean,format:string,"
    "warnings:array<string>,usage:map<string,string>,crop_path:string>"
)
VISUAL = "struct<candidate_id:string,page:int,norm_rect:array<double>,semantic:string,resolution:string,resolved_value:string,reasons:array<string>,detection_confidence:double,value_confidence:double>"
STATE = (
    "schema_version int, pdf_name string, pdf_size bigint, page int, page_index int, total_pages int, dpi int, page_dir string, page_size array<double>, status string, completed_stage string, page_role string, "
    f"picture_records array<{PICTURE}>, raw_markdown string, refined_markdown string, final_markdown string, pre_repair_markdown string, pre_repair_warnings map<string,string>, table_candidates array<{CANDIDATE}>, "
    f"visual_values_mode string, visual_candidates array<{VISUAL}>, warnings map<string,string>, layout_blocks int, stage_history array<{RECORD}>, failure string"
)
#: Files that a page leaves, by the first stage that makes them anew.
DOWNSTREAM = {
    "picture_triage": ("image_summaries.jsonl",), "picture_extract": ("image_summaries.jsonl",),
    "table_detect": ("table_candidates.json", "table_candidates_overlay.png", "table_reconstruction.json", "table_reconstruction_overlay.png", "visual_candidates.json"),
    "table_extract": ("table_candidates.json", "table_candidates_overlay.png", "table_candidates", "table_reconstruction.json", "table_reconstruction_overlay.png", "visual_candidates.json"),
    "page_refine": ("page_model.md", "page_model_input.png", "page_repair.md", "page_final.md", "layout_map_repair.json"),
    "page_repair": ("page_model_input.png", "page_repair.md", "page_final.md", "layout_map_repair.json"), "finalize": ("page_final.md", "image_summaries.jsonl"),
}
CODE_LIKE, MESSAGE_CHARS = r"^[A-Za-z0-9_.:-]{1,64}\z", 160


def page_dir(page: Column) -> Column:
    return F.format_string("page_%04d", page)


def relative(path: Column, folder: Column) -> Column:
    """A path inside a page's folder as one from there; any other as it is."""
    return F.when(F.startswith(path, F.concat(folder, F.lit("/"))), F.substr(path, F.length(folder) + 2)).otherwise(path)


def resolved(path: Column, folder: Column) -> Column:
    return F.when(F.startswith(path, F.lit("/")) | F.rlike(path, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), path).otherwise(F.concat_ws("/", folder, path))


def new_states(pages: DataFrame) -> DataFrame:
    """A row of STATE for each page to do (pdf_name, pdf_size, page, page_index, total_pages, dpi, page_size)."""
    given = {c: F.col(c) for c in pages.columns} | {
        "schema_version": F.lit(SCHEMA_VERSION), "page_dir": page_dir(F.col("page")), "status": F.lit("pending"), "visual_values_mode": F.lit("off"), "stage_history": F.array().cast(f"array<{RECORD}>"),
    }
    fields = SparkSession.getActiveSession().createDataFrame([], STATE).schema
    return pages.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def save(states: DataFrame, path: str) -> None:
    """Checkpoints, a folder a page; a page that is saved again replaces its own folder only."""
    states.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("page").json(path, ignoreNullFields=False)


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(states, refused): saved pages by their declared schema, and those of another version."""
    rows = spark.read.schema(STATE + ", _broken string").option("columnNameOfCorruptRecord", "_broken").json(path).cache()
    good = F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)) & F.col("_broken").isNull()
    return rows.where(good).drop("_broken"), rows.where(~good).select("page", "schema_version", "_broken")


def portable(states: DataFrame) -> DataFrame:
    """States whose pictures and crops have paths from their page's folder."""
    d = F.col("page_dir")
    return states.withColumn("picture_records", F.transform("picture_records", lambda r: r.withField("abs_path", relative(r["abs_path"], d)))).withColumn(
        "table_candidates", F.transform("table_candidates", lambda c: c.withField("crop_path", relative(c["crop_path"], d)))
    )


def located(states: DataFrame) -> DataFrame:
    d = F.col("page_dir")
    return states.withColumn("picture_records", F.transform("picture_records", lambda r: r.withField("abs_path", resolved(r["abs_path"], d)))).withColumn(
        "table_candidates", F.transform("table_candidates", lambda c: c.withField("crop_path", resolved(c["crop_path"], d)))
    )


def synced(states: DataFrame, changes: DataFrame, key: str = "page") -> DataFrame:
    """States with the columns that changes (key, some columns) bring; a null changes nothing."""
    met = states.join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in changes.columns if c != key]), key, "left")
    return met.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c != key and c in changes.columns else F.col(c) for c in states.columns])


def with_record(states: DataFrame, stage: Column, status: Column, seconds: Column, details: Column, error_type: Column, message: Column, at: Column) -> DataFrame:
    """States after a stage: its record in the history, and the page's status.  A stage that fails marks its page, and no other."""
    record = F.struct(stage.alias("stage"), status.alias("status"), F.round(seconds, 3).alias("elapsed_seconds"), details.alias("details"), error_type.alias("error_type"), F.substring(message, 1, MESSAGE_CHARS).alias("error_message"), at.alias("recorded_at"))
    failed = status == "fail"
    out = states.withColumn("stage_history", F.concat(F.coalesce("stage_history", F.array().cast(f"array<{RECORD}>")), F.array(record.cast(RECORD))))
    out = out.withColumn("status", F.when(failed, "failed").when(stage == STAGES[-1], "completed").otherwise("ready"))
    return out.withColumn("failure", F.when(failed, F.concat_ws(": ", error_type, F.substring(message, 1, MESSAGE_CHARS))).otherwise(F.col("failure"))).withColumn("completed_stage", F.when(failed, F.col("completed_stage")).otherwise(stage))


def skipped(states: DataFrame, stage: str, reason: str, at: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    return with_record(states, F.lit(stage), F.lit("skipped"), F.lit(0.0), F.create_map(F.lit("reason"), F.lit(reason)), none, none, at)


def invalidated(states: DataFrame, stage: Column) -> DataFrame:
    """States as a replay from a stage needs them: what that stage and later ones own is cleared, and a page that was repaired has again
    what it had before.  A stage that a page has not come to clears nothing."""
    order = F.lit(list(STAGES))
    start, done = F.array_position(order, stage), F.coalesce(F.nullif(F.array_position(order, F.col("completed_stage")), F.lit(0)), F.lit(len(STAGES)))
    on = lambda name: (start <= STAGES.index(name) + 1) & (start <= done)
    text, words, usage = F.lit(""), F.array().cast("array<string>"), F.lit(None).cast("map<string,string>")

    def fields(struct: Column, values: dict) -> Column:
        for name, value in values.items():
            struct = struct.withField(name, value)
        return struct

    triage = {"triage_type": text, "triage_confidence": F.lit(None).cast("double"), "triage_action": text, "triage_usage": usage, "triage_warnings": words}
    summary = {"summary": text, "summary_type": text, "summary_warnings": words, "usage": usage}
    table = {"markdown": text, "verified": F.lit(False), "warnings": words, "usage": usage, "crop_path": F.lit(None).cast("string")}
    pictures = F.transform("picture_records", lambda r: F.when(on("picture_triage"), fields(fields(r, triage), summary)).when(on("picture_extract"), fields(r, summary)).otherwise(r))
    sectioned = lambda c: F.coalesce(c["format"] == "sectioned_table", F.lit(False))
    tables = F.when(on("table_detect"), F.array().cast(f"array<{CANDIDATE}>")).when(on("table_extract"), F.transform("table_candidates", lambda c: F.when(sectioned(c), c).otherwise(fields(c, table)))).otherwise(F.col("table_candidates"))
    none = F.map_from_arrays(words, words)
    restored = on("page_repair") & ~on("page_refine") & (F.coalesce("pre_repair_markdown", F.lit("")) != "")
    back = F.get(order, (start - 2).cast("int"))
    return states.withColumns(
        {
            "picture_records": pictures, "table_candidates": tables, "visual_values_mode": F.when(on("table_detect"), "off").otherwise(F.col("visual_values_mode")),
            "visual_candidates": F.when(on("table_detect"), F.array().cast(f"array<{VISUAL}>")).otherwise(F.col("visual_candidates")),
            "refined_markdown": F.when(on("page_refine"), "").otherwise(F.col("refined_markdown")), "final_markdown": F.when(on("page_refine"), "").when(restored, F.col("pre_repair_markdown")).otherwise(F.col("final_markdown")),
            "warnings": F.when(on("page_refine"), none).when(restored, F.col("pre_repair_warnings")).otherwise(F.col("warnings")), "pre_repair_markdown": F.when(on("page_refine"), "").otherwise(F.col("pre_repair_markdown")),
            "pre_repair_warnings": F.when(on("page_refine"), none).otherwise(F.col("pre_repair_warnings")), "status": F.when(on("finalize"), "ready").otherwise(F.col("status")),
            "failure": F.when(on("finalize"), None).otherwise(F.col("failure")), "completed_stage": F.when(start <= done, back).otherwise(F.col("completed_stage")),
        }
    )


def downstream_files(pages: DataFrame) -> DataFrame:
    """(page, file) that a replay from a stage (page, stage) makes anew, so an old one must not stay."""
    order = F.lit(list(STAGES))
    rows = [(stage, name) for stage, names in DOWNSTREAM.items() for name in names]
    files = pages.sparkSession.createDataFrame(rows, "owner string, file string")
    met = pages.join(F.broadcast(files), F.array_position(order, F.col("owner")) >= F.array_position(order, F.col("stage")))
    return met.select("page", "file").distinct()


def failed(states: DataFrame) -> DataFrame:
    return states.where((F.col("status") == "failed") | F.col("failure").isNotNull())


# --- progress -----------------------------------------------------------------------------------------------------


def safe_detail(value: Column) -> Column:
    """A detail that may be published: a number, a flag, or a word like a code; else null."""
    return F.when(F.rlike(value, F.lit(CODE_LIKE)), value)


def shown(value: Column) -> Column:
    """A value in a status line: flags as words, no blanks."""
    flag = F.when(value == "true", "yes").when(value == "false", "no")
    return F.coalesce(flag, F.replace(F.regexp_replace(value, r"[\n\r]", " "), F.lit(" "), F.lit("_")))


def progress_events(records: DataFrame) -> DataFrame:
    """Records (page, page_index, total_pages, stage, status, seconds, details map, error_type) with `payload`, the JSON of their event, and
    `line` for people.  Messages are never published; an event that breaks its contract has no payload."""
    is_page = F.col("stage") == "page"
    safe = F.map_filter(F.transform_values("details", lambda _, v: safe_detail(v)), lambda _, v: v.isNotNull())
    fields = F.struct(
        F.lit(co.PROGRESS).alias("contract"), F.lit(co.VERSION).alias("contract_version"), F.when(is_page, "page").otherwise("page_stage").alias("event"), "status", F.when(~is_page, F.col("stage")).alias("stage"), "page", "page_index",
        "total_pages", F.round("seconds", 3).alias("seconds"), F.substring("error_type", 1, 80).alias("error_type"), F.when(F.size(safe) > 0, safe).alias("detail"),
    )
    shown_details = F.array_join(F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], F.lit("="), shown(e["value"]))), " ")
    parts = F.array_compact(F.array(F.format_string("[%d/%d p%04d]", "page_index", "total_pages", "page"), F.upper("stage"), F.col("status"), F.when(F.col("seconds").isNotNull(), F.format_string("seconds=%.1f", "seconds")), F.nullif(shown_details, F.lit(""))))
    out = records.withColumn("payload", F.to_json(fields)).withColumn("line", F.array_join(parts, " "))
    return out.withColumn("error", co.progress_error(F.col("payload"))).withColumn("payload", F.when(F.col("error").isNull(), F.col("payload")))


# --- run ----------------------------------------------------------------------------------------------------------


def manifest_rows(states: DataFrame) -> DataFrame:
    """A row for each page of what it holds: status, counts, kinds of tables, pictures, warnings, history."""
    kinds = F.array_sort(F.array_distinct(F.transform("table_candidates", lambda c: c["kind"])))
    used = F.filter("table_candidates", lambda c: c["usage"].isNotNull())
    return states.select(
        "page", page_dir(F.col("page")).alias("page_dir"), "status", "failure", F.nullif("page_role", F.lit("")).alias("page_role"), F.coalesce("layout_blocks", F.lit(0)).alias("layout_block_count"),
        F.size(F.coalesce("table_candidates", F.array().cast(f"array<{CANDIDATE}>"))).alias("table_candidate_count"), kinds.alias("table_candidate_kinds"),
        F.size(F.coalesce("visual_candidates", F.array().cast(f"array<{VISUAL}>"))).alias("visual_candidate_count"), F.transform(used, lambda c: F.struct(c["candidate_id"], c["kind"], c["usage"])).alias("table_extraction_usage"),
        F.size(F.coalesce("picture_records", F.array().cast(f"array<{PICTURE}>"))).alias("picture_count"), "warnings", "stage_history",
    )


def usage_calls(states: DataFrame) -> DataFrame:
    """(page, stage, prompt_tokens, output_tokens, duration) of every model call that pages record: triage and summaries of pictures, tables.
    Calls for whole pages come from the stage records, whose details name their usage."""
    number = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)).try_cast("bigint"), F.lit(0))
    parts = []
    for column, field, stage in (("picture_records", "triage_usage", "picture_triage"), ("picture_records", "usage", "image_summary"), ("table_candidates", "usage", "table_extraction")):
        one = states.select("page", F.explode(column).alias("x")).select("page", F.lit(stage).alias("stage"), F.col(f"x.{field}").alias("u"))
        parts.append(one)
    history = states.select("page", F.explode("stage_history").alias("x")).where(F.map_contains_key(F.col("x.details"), F.lit("prompt_tokens")))
    parts.append(history.select("page", F.col("x.stage").alias("stage"), F.col("x.details").alias("u")))
    calls = parts[0]
    for p in parts[1:]:
        calls = calls.unionByName(p)
    u = F.col("u")
    return calls.where("u is not null").select("page", "stage", number(u, "prompt_tokens").alias("prompt_tokens"), number(u, "output_tokens").alias("output_tokens"), number(u, "total_duration").alias("duration"))


def run_record(states: DataFrame, source: dict, settings: dict, prompts: dict[str, str], stale: DataFrame, generated_at: str) -> str:
    """The run record as JSON.  source: filename, sha256, page_count.  Prompts go in as digests; pages that failed are told, and it is for
    readers to refuse them.  What is read from the pages are one row of counts, a row for each warning, and the stale folders."""
    first, last, n, completed = states.agg(F.min("page"), F.max("page"), F.count("*"), F.count_if(F.col("status") == "completed")).first()
    warned = states.select("page", F.explode("warnings").alias("category", "value")).where(F.col("value").isNotNull() & ~F.col("value").isin("", "0", "false", "[]"))
    categories = {r[0]: r[1] for r in warned.groupBy("category").agg(F.countDistinct("page")).orderBy("category").collect()}
    given = {k: settings[k] for k in sorted(settings)} | {"table_reconstruction_version": RECONSTRUCTION_VERSION, "visual_collector_version": COLLECTOR_VERSION}
    given["prompt_sha256"] = {k: hashlib.sha256(v.encode()).hexdigest() for k, v in sorted(prompts.items())}
    record = {
        "contract": co.RUN, "contract_version": co.VERSION, "generated_at": generated_at, "source": {k: source[k] for k in ("filename", "sha256", "page_count")},
        "selection": {"start_page": first, "end_page": last, "page_count": last - first + 1, "complete_document": first == 1 and last == source["page_count"]}, "coordinate_convention": co.CONVENTION,
        "artifacts": {"root": {r: f"{r}.json" for r in co.ROOT_ROLES}, "page": {r: r for r in co.PAGE_ROLES}}, "evidence_bearing_roles": list(co.EVIDENCE_ROLES), "settings": given,
        "pages": {"completed": completed, "failed": n - completed}, "warnings": {"total": sum(categories.values()), "categories": categories, "stale_page_dirs": sorted(r[0] for r in stale.select("page_dir").collect())},
    }
    return json.dumps(record, ensure_ascii=False)


def shard_suffix(first: int, last: int, shard: bool) -> str:
    return f"_p{first:04d}-p{last:04d}" if shard else ""


def write_run(states: DataFrame, path: str, blocks: DataFrame, *, shard: bool = False) -> bool:
    """Manifest, blocks and combined texts of a run under `path`; False, and nothing written, if there are no pages.  Blocks are those of
    completed pages.  The folders of all pages that were ever saved are aggregated by `write_all`."""
    ends = states.agg(F.min("page"), F.max("page")).first()
    if ends[0] is None:
        return False
    suffix = shard_suffix(*ends, shard)
    manifest_rows(states).orderBy("page").write.mode("overwrite").json(f"{path}/manifest{suffix}", ignoreNullFields=False)
    done = states.where("status = 'completed'")
    blocks.join(done.select("page"), "page", "left_semi").write.mode("overwrite").json(f"{path}/blocks{suffix}", ignoreNullFields=False)
    combined(done, "final_markdown").write.mode("overwrite").text(f"{path}/combined_final{suffix}")
    combined(states, "raw_markdown").write.mode("overwrite").text(f"{path}/combined_raw{suffix}")
    return True


def write_all(spark: SparkSession, saved: str, path: str) -> DataFrame:
    """The same over all saved pages, whichever run made them; gives back the checkpoints that could not be read."""
    states, refused = load(spark, saved)
    manifest_rows(states).orderBy("page").write.mode("overwrite").json(f"{path}/all/manifest", ignoreNullFields=False)
    combined(states.where("status = 'completed'"), "final_markdown").write.mode("overwrite").text(f"{path}/all/combined_final")
    return refused


def combined(states: DataFrame, column: str) -> DataFrame:
    """Texts of pages in order, each under its banner; pages without one are left out.  A row a page, so a long document is no single
    value; rows are in page order."""
    full = states.where(F.coalesce(F.col(column), F.lit("")) != "")
    part = F.concat(F.lit("===== "), page_dir(F.col("page")), F.lit(" =====\n\n"), F.regexp_replace(F.col(column), r"^\s+", ""))
    return full.orderBy("page").select(part.alias("value"))


# --- replay of saved pages ----------------------------------------------------------------------------------------


def saved_texts(raw: DataFrame, refined: DataFrame, model: DataFrame) -> DataFrame:
    """(page, raw, working): the text a replay starts from, refined if there is one, else the model's, else the raw one."""
    met = raw.select("page", F.col("markdown").alias("raw")).join(refined.select("page", F.col("markdown").alias("refined")), "page", "left").join(model.select("page", F.col("markdown").alias("model")), "page", "left")
    return met.select("page", F.coalesce("raw", F.lit("")).alias("raw"), F.coalesce("refined", "model", "raw", F.lit("")).alias("working"))


def edge_lines(lines: DataFrame, *keys: str, reach: int = 3, chars: int = 120) -> DataFrame:
    """(keys, line): short plain lines among the first and last three of a page."""
    full = lines.where(tx.strip(F.col("line")) != "")
    w = Window.partitionBy(*keys)
    n, k = F.count("*").over(w), F.row_number().over(w.orderBy("pos"))
    near = full.withColumn("n", n).withColumn("k", k).where((F.col("k") <= reach) | (F.col("k") > F.col("n") - reach))
    t = tx.strip(F.col("line"))
    return near.where(~F.rlike(t, F.lit(r"^[#|>!\-*+]|^\d+[.)]\s")) & (F.length(t) <= chars)).select(*keys, t.alias("line")).distinct()


def footer_texts(edges: DataFrame, *keys: str, page: str = "page", least: int = 3) -> DataFrame:
    """(keys, norm): edge lines that stand on three pages or more."""
    norm = tx.furniture_text(F.col("line"))
    return edges.select(*keys, page, norm.alias("norm")).where("norm != ''").distinct().groupBy(*keys, "norm").agg(F.count("*").alias("pages")).where(F.col("pages") >= least).select(*keys, "norm")


def safe_name(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_.-]", "_", name)

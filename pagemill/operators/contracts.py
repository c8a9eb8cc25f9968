"""Published records checked as Columns: the first rule that a payload breaks, or null.

Payloads are JSON text.  Unknown and missing keys, types and values are told apart, and no message repeats a value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contracts.
PROGRESS, RUN, VERSION, CONVENTION = "pagemill/progress", "pagemill/run", "1.0", "normalized_top_left"
EVENTS, STATUSES = ("run", "page", "page_stage"), ("start", "ok", "skip", "fail", "resume")
PROGRESS_KEYS = (
    ("contract", True, "string"), ("contract_version", True, "string"), ("event", True, "string"), ("status", True, "string"), ("stage", False, "string"), ("page", False, "int"),
    ("page_index", False, "int"), ("total_pages", False, "int"), ("seconds", False, "number"), ("error_type", False, "string"), ("detail", False, "object"),
)
RUN_KEYS = (
    "contract", "contract_version", "generated_at", "source", "selection", "coordinate_convention", "artifacts", "evidence_bearing_roles", "settings", "pages", "warnings",
)
PAGE_ROLES = ("page_markdown", "page_image", "layout_map", "table_candidates", "page_state", "image_summaries")
ROOT_ROLES = ("run", "manifest", "blocks")
EVIDENCE_ROLES = ("manifest", "blocks", "page_markdown", "page_image", "layout_map", "table_candidates", "page_state", "image_summaries")


def _first(*checks: tuple[Column, str]) -> Column:
    """Message of the first condition that holds."""
    out = F.when(checks[0][0], checks[0][1])
    for condition, message in checks[1:]:
        out = out.when(condition, message)
    return out


_TYPES = {"string": r"^STRING\z", "int": r"^BIGINT\z", "number": r"^(?:BIGINT|DOUBLE|DECIMAL.*)\z", "object": r"^OBJECT.*\z", "array": r"^ARRAY.*\z", "bool": r"^BOOLEAN\z"}


class _Payload:
    """A payload that was parsed once: its keys, and values at a path."""

    def __init__(self, parsed: Column):
        self.value, self.keys = parsed["value"], parsed["keys"]

    def get(self, path: str, kind: str = "string") -> Column:
        return F.try_variant_get(self.value, F.lit(f"$.{path}"), kind)

    def has(self, key: str) -> Column:
        return F.array_contains(self.keys, key)

    def is_a(self, path: str, kind: str) -> Column:
        """Whether the value has the type, from the type of the variant at the path."""
        return F.rlike(F.schema_of_variant(self.get(path, "variant")), F.lit(f"(?s){_TYPES[kind]}"))


def _checked(payload: Column, rules) -> Column:
    """First fault of a payload by `rules`, which take it as parsed: one parse for all of them."""
    keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
    value = F.when(F.startswith(F.ltrim(payload), F.lit("{")), F.try_parse_json(payload))
    return F.get(F.transform(F.array(F.struct(value.alias("value"), keys.alias("keys"))), lambda x: _first((x["value"].isNull(), "not an object"), *rules(_Payload(x)))), F.lit(0))


def progress_error(payload: Column) -> Column:
    """First fault of a progress event; null for a good one."""

    def rules(p: _Payload) -> list[tuple[Column, str]]:
        required = [k for k, need, _ in PROGRESS_KEYS if need]
        event = p.get("event")
        checks = [(F.size(F.array_except(p.keys, F.lit([k for k, _, _ in PROGRESS_KEYS]))) > 0, "unknown key"), (F.size(F.array_except(F.lit(required), p.keys)) > 0, "missing key")]
        for k, need, kind in PROGRESS_KEYS:
            present = p.has(k) if need else p.get(k, "variant").isNotNull() & ~F.coalesce(F.is_variant_null(p.get(k, "variant")), F.lit(False))
            checks.append((present & ~F.coalesce(p.is_a(k, kind), F.lit(False)), f"{k}: wrong type"))
        checks += [
            (p.get("contract") != PROGRESS, "contract"), (p.get("contract_version") != VERSION, "version"), (~event.isin(*EVENTS), "event"), (~p.get("status").isin(*STATUSES), "status"),
            (event.isin("page", "page_stage") & ~p.has("page"), "page event without page"), ((event == "page_stage") & (F.coalesce(p.get("stage"), F.lit("")) == ""), "stage event without stage"),
        ]
        return checks + [(p.get(k, "bigint") < 1, f"{k}: not from 1") for k in ("page", "page_index", "total_pages")]

    return _checked(payload, rules)


def progress_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines of a log that are progress events: with payload and error; other lines are text and go."""
    t = F.btrim(line)
    kept = lines.where(F.startswith(t, F.lit("{")) & (F.get_json_object(t, "$.contract") == PROGRESS)).withColumn("payload", t)
    return kept.withColumn("error", progress_error(F.col("payload")))


def path_error(path: Column) -> Column:
    """Whether a published path is not a relative, contained one with forward slashes."""
    return path.isNull() | (path == "") | F.contains(path, F.lit("\\")) | F.rlike(path, F.lit(r"^/|(?:^|/)\.\.(?:/|\z)|^[A-Za-z]:"))


def run_error(payload: Column) -> Column:
    """First fault of a run record; null for a good one."""

    def rules(p: _Payload) -> list[tuple[Column, str]]:
        num = lambda path: F.coalesce(p.get(path, "bigint"), F.lit(-1))
        whole = (num("selection.start_page") == 1) & (num("selection.end_page") == num("source.page_count"))
        checks = [
            (F.size(F.array_except(p.keys, F.lit(list(RUN_KEYS)))) > 0, "unknown key"), (F.size(F.array_except(F.lit(list(RUN_KEYS)), p.keys)) > 0, "missing key"),
            (p.get("contract") != RUN, "contract"), (p.get("contract_version") != VERSION, "version"), (p.get("coordinate_convention") != CONVENTION, "coordinates"),
            (~F.rlike(F.coalesce(p.get("source.sha256"), F.lit("")), F.lit(r"^[0-9a-f]{64}\z")), "sha256"),
            ((num("selection.start_page") < 1) | (num("selection.start_page") > num("selection.end_page")), "page range"),
            (num("selection.page_count") != num("selection.end_page") - num("selection.start_page") + 1, "page count"), (num("selection.end_page") > num("source.page_count"), "end page"),
            (F.coalesce(p.get("selection.complete_document", "boolean"), F.lit(False)) != whole, "complete document"),
        ]
        for scope, roles in (("root", ROOT_ROLES), ("page", PAGE_ROLES)):
            published = F.coalesce(F.map_keys(p.get(f"artifacts.{scope}", "map<string,variant>")), F.array().cast("array<string>"))
            checks.append((F.array_sort(published) != F.array_sort(F.lit(list(roles))), f"{scope} roles"))
            checks += [(path_error(p.get(f"artifacts.{scope}.{r}")), f"{scope}.{r}: path") for r in roles]
        evidence = F.coalesce(p.get("evidence_bearing_roles", "array<string>"), F.array().cast("array<string>"))
        return [*checks, (evidence != F.lit(list(EVIDENCE_ROLES)), "evidence roles"), (num("pages.failed") != 0, "failed pages")]

    return _checked(payload, rules)

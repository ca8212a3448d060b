"""Running named steps in one session, with a log of what ran and how long it took."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import materialize


@dataclass(frozen=True)
class Step:
    """A step makes a table from the tables before it. An optional step may fail without ending the run."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], DataFrame]
    tags: tuple[str, ...] = ()
    optional: bool = False


@dataclass
class RunLog:
    generated_at: str
    steps: list[dict] = field(default_factory=list)

    @property
    def total_elapsed_seconds(self) -> float:
        return round(sum(s["elapsed_seconds"] for s in self.steps), 3)

    def to_json(self) -> str:
        return json.dumps({"generated_at": self.generated_at, "total_elapsed_seconds": self.total_elapsed_seconds, "steps": self.steps}, ensure_ascii=False, indent=2)


def write_log(log: RunLog, folder: str) -> Path:
    """The log as a JSON file named by its time."""
    target = Path(folder, f"pipeline-run-{datetime.now(UTC).strftime('%Y%m%dT%H%M%SZ')}.json")
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(log.to_json(), encoding="utf-8")
    return target


def load_steps(path: str, known: Iterable[Step] | None = None) -> list[Step]:
    """The steps of a JSON file {"steps": [{"name", "tags", "optional"}]} in its order; their code is that of the known steps."""
    data = json.loads(Path(path).read_text(encoding="utf-8"))
    steps = data.get("steps") if isinstance(data, dict) else None
    if not isinstance(steps, list):
        raise ValueError(f"{path}: steps must be a list")
    code = {s.name: s for s in (default_steps() if known is None else known)}
    out = []
    for x in steps:
        if x.get("name") not in code:
            raise ValueError(f"{path}: there is no step {x.get('name')}")
        own = code[x["name"]]
        out.append(Step(own.name, own.run, tuple(x.get("tags", own.tags)), bool(x.get("optional", own.optional))))
    return out


def select_steps(steps: Iterable[Step], run: Iterable[str] = (), skip: Iterable[str] = ("indexing",)) -> list[Step]:
    """Steps with a tag or name in `run` (all if empty) and none in `skip`; skip wins."""
    wanted, unwanted = set(run), set(skip)
    out = []
    for s in steps:
        own = {s.name, *s.tags}
        if own & unwanted or wanted and not own & wanted:
            continue
        out.append(s)
    return out


def run_steps(spark: SparkSession, steps: Iterable[Step], tables: dict[str, DataFrame], folder: str) -> tuple[dict[str, DataFrame], RunLog]:
    """Runs steps in order; each result is written below `folder` and read again, so later steps start from it.

    The first failure of a step that is not optional ends the run; the log tells which.
    """
    log = RunLog(datetime.now(UTC).isoformat(timespec="seconds"))
    tables = dict(tables)
    for s in steps:
        began, code = time.time(), 0
        try:
            path = f"{folder.rstrip('/')}/{s.name}"
            s.run(spark, tables).write.mode("overwrite").parquet(path)
            tables[s.name] = spark.read.parquet(path)
        except Exception as e:  # noqa: BLE001 - any failure is logged
            code = 1
            message = str(e).split("\n")[0][:300]
        entry = {"step": s.name, "returncode": code, "elapsed_seconds": round(time.time() - began, 3), "optional": s.optional}
        log.steps.append(entry | ({"message": message} if code else {}))
        if code and not s.optional:
            break
    return tables, log


def default_steps() -> list[Step]:
    """Pages to drafts, their validation, index views and audits. Tables needed: pages, waivers, books.

    The index views of unreviewed drafts have the tag `indexing`, which `select_steps` skips by default.
    """
    from ..operators import audits, documents, indexes, quality, references, sections, segments, structure

    key = ["publication_id", "lesson_number"]

    def contents(s, t):
        return structure.contents_index(structure.contents_rows(t["lines"], structure.contents_candidates(t["lines"])))

    def drafts(s, t):
        said = t["readings"].withColumn("reading_no", F.monotonically_increasing_id())
        said = materialize(said)
        refs = references.parse(said, t["books"], ["reading_no"]).groupBy("reading_no").agg(F.array_sort(F.collect_list(F.struct("ref_no", "testament", "book_standardized", "chapter", "verse_start", "verse_end"))).alias("x"))
        refs = refs.select("reading_no", F.transform("x", lambda r: F.struct(*[r[c].alias(c) for c in ("testament", "book_standardized", "chapter", "verse_start", "verse_end")])).alias("canonical_references"))
        readings = said.join(refs, "reading_no", "left").dropDuplicates(key)
        items = t["items"].groupBy(*key, "section").agg(F.array_sort(F.collect_list(F.struct("item_no", "text"))).alias("x")).select(*key, "section", F.transform("x", lambda r: r["text"]).alias("items"))
        return documents.with_paths(documents.draft_lessons(t["segments"], readings, items, traces=t["traces"]))

    def audit(s, t):
        return audits.content_audits(t["missing"], audits.title_inconsistencies(t["segments"].select(*key, F.col("expected_title").alias("title"))), t["validation"].where("error like 'reading%'"))

    return [
        Step("gate", lambda s, t: quality.gate(t["pages"]), ("quality",)),
        Step("report", lambda s, t: quality.publication_report(t["gate"], t["waivers"]), ("quality",)),
        Step("normalized", lambda s, t: structure.normalized_pages(t["pages"]), ("structure",)),
        Step("lines", lambda s, t: sections.body_lines(structure.lines_of_pages(t["normalized"])), ("structure",)),
        Step("markers", lambda s, t: structure.markers(t["lines"]), ("structure",)),
        Step("contents", contents, ("structure",)),
        Step("segments", lambda s, t: segments.segments(t["contents"], t["markers"], t["lines"]), ("segmentation",)),
        Step("labels", lambda s, t: sections.labels(t["lines"], t["segments"]), ("sections",)),
        Step("readings", lambda s, t: sections.readings(t["lines"], t["labels"]), ("sections",)),
        Step("blocks", lambda s, t: sections.blocks(t["lines"], t["labels"]), ("sections",)),
        Step("outlines", lambda s, t: sections.outlines(t["lines"], t["labels"]), ("sections",)),
        Step("items", lambda s, t: sections.items(t["blocks"], t["outlines"]), ("sections",)),
        Step("traces", lambda s, t: sections.traces(t["blocks"].unionByName(t["outlines"])), ("sections",)),
        Step("missing", lambda s, t: audits.missing_sections(sections.present(t["readings"], t["blocks"], t["outlines"]), t["segments"]), ("audit",), optional=True),
        Step("drafts", drafts, ("drafts",)),
        Step("validation", lambda s, t: documents.first_error(t["drafts"].drop("path"), key), ("drafts",)),
        Step("lessons_index", lambda s, t: indexes.lessons_index(t["drafts"]), ("indexing",), optional=True),
        Step("section_outline", lambda s, t: indexes.section_outline_index(t["drafts"]), ("indexing",), optional=True),
        Step("scripture", lambda s, t: indexes.scripture_index(t["drafts"]), ("indexing",), optional=True),
        Step("audit", audit, ("audit",), optional=True),
    ]

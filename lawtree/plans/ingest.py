"""Registration of files in a warehouse, one batch at a time."""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree import schema as S
from lawtree.functions import scalars
from lawtree.operators import stats, tree, validate
from lawtree.plans.warehouse import Warehouse, no_rows
from lawtree.scratch import checkpointed, scratch_path
from lawtree.sources import files as sources
from lawtree.sources import xml

_LISTING = ["path", "modification_time", "length"]
RESULT = [*_LISTING, "code", "outcome"]

# Spans of modification time that a run hands to the reader, however many files are open.
SPANS = 64
# Bitmaps of 32,768 bits in the filter that holds a batch's strings against the dictionary.
BITMAPS = 4_096
# Files that a Python worker gets at a time; Spark bounds their bytes besides.
FILES = 500
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def reading(strip_ws: bool, fold_width: bool) -> str:
    """The options that shape a law's number. An outcome holds for runs that read numbers the same way."""
    return f"strip_ws={strip_ws},fold_width={fold_width}"


def settled_files(listing: DataFrame, states: DataFrame, read_as: str, reiki_only: bool = True) -> DataFrame:
    """Unchanged files that an earlier batch registered or skipped, with their outcome now."""
    final = ["registered", "skipped_known"] + (["skipped_not_reiki"] if reiki_only else [])
    known = states.where((F.col("reading") == read_as) & F.col("outcome").isin(*final))
    known = known.select(*_LISTING, F.col("outcome").alias("before"))
    outcome = F.when(F.col("before") == "skipped_not_reiki", F.col("before")).otherwise("skipped_known")
    return listing.join(known, _LISTING).withColumn("outcome", outcome).select(*RESULT)


def time_spans(open_files: DataFrame) -> Column:
    """A condition on ``modification_time`` that all of ``open_files`` meet and few others.

    The range of their times is cut into SPANS parts, and each part shrinks to the times in it. A
    reader of files takes the condition over and opens no file outside.
    """
    time = F.unix_micros("modification_time")
    whole = open_files.agg(F.min(time).alias("low"), F.max(time).alias("high"), F.count_if(time.isNull()).alias("unknown")).first()
    condition = F.col("modification_time").isNull() if whole.unknown else F.lit(False)
    if whole.low is None:
        return condition
    part = F.expr(f"({SPANS} * (unix_micros(modification_time) - {whole.low})) div {whole.high - whole.low + 1}")
    spans = open_files.where(time.isNotNull()).groupBy(part.alias("part")).agg(F.min(time).alias("low"), F.max(time).alias("high"))
    for span in sorted(spans.collect()):  # at most SPANS rows
        low, high = (F.timestamp_micros(F.lit(t)) for t in (span.low, span.high))
        condition = condition | F.col("modification_time").between(low, high)
    return condition


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get FILES files at a time, if they would get more: what they hold is then the same at any size of input."""
    before = spark.conf.get(ARROW_ROWS)
    if not 0 < int(before) <= FILES:
        spark.conf.set(ARROW_ROWS, FILES)
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def number_id() -> Column:
    """Id of a law in the warehouse: by its number, whatever file it comes from."""
    return scalars.hash_id(F.col("muni_id"), F.col("law_num"))


def new_laws(candidates: DataFrame, registered: DataFrame) -> DataFrame:
    """Candidates whose ``(muni_id, num)`` is not registered yet, the lowest file of each.

    Candidates need muni_id, law_num, file_id and path; registered laws muni_id and
    num. A number that very many files share is down to one row before the join.
    """
    taken = registered.select("muni_id", F.col("num").alias("law_num"))
    return lowest_file(candidates).join(taken, ["muni_id", "law_num"], "left_anti")


def lowest_file(candidates: DataFrame) -> DataFrame:
    """One row per ``(muni_id, law_num)``: the file with the lowest id."""
    first = F.min(F.struct("file_id", "path")).alias("first")
    return candidates.groupBy("muni_id", "law_num").agg(first).select(
        "muni_id", "law_num", number_id().alias("law_id"), "first.file_id", "first.path"
    )


def _lowest_per_id(winners: DataFrame, registered: DataFrame) -> DataFrame:
    """One new law per ``law_id``, with a flag: may another law have that id already?"""
    first = F.min(F.struct("file_id", "path"))["path"].alias("path")
    by_id = winners.groupBy("law_id").agg(F.count(F.lit(1)).alias("n"), first)
    before = registered.select("law_id", F.lit(True).alias("taken"))
    taken = F.coalesce("taken", F.lit(False))
    return by_id.join(before, "law_id", "left").select(
        "path", taken.alias("taken"), (taken | (F.col("n") > 1)).alias("collides")
    )


def string_rows(elements: DataFrame) -> DataFrame:
    """``string_edges`` rows with the string itself."""
    return tree.sentences(elements).select(
        "law_id", "elem_id", "sentence_num",
        scalars.string_id(F.col("sentence")).alias("string_id"),
        F.col("sentence").alias("string"),
    )


def possibly_among(known: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``string_id`` of ``known`` that may be among ``ids``: all that are, and some that are not.

    The ids set bits in a filter of BITMAPS bitmaps of 4 KB, 16 MB whatever their number; its size is
    the bound of the broadcast. Ids so many that most bits are set let all of ``known`` pass.
    """
    bit = F.xxhash64("string_id").bitwiseAND(F.lit(BITMAPS * 32_768 - 1)) + 1
    numbered = {"bucket": F.bitmap_bucket_number(bit), "place": F.bitmap_bit_position(bit)}
    bitmaps = ids.select("string_id").withColumns(numbered).groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
    byte = "cast(conv(hex(substring(bits, cast(place div 8 + 1 AS int), 1)), 16, 10) AS int)"
    met = known.select("string_id").withColumns(numbered).join(F.broadcast(bitmaps), "bucket")
    return met.where(f"shiftright({byte}, cast(place % 8 AS int)) & 1 = 1").select("string_id")


def new_strings(elements: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct sentences that the dictionary ``known`` lacks.

    The dictionary outgrows every batch, so it is filtered where it is scanned: what is shuffled of it
    are the ids that the batch may hold, as many as the batch has and a few more.
    """
    strings = stats.distinct_strings(tree.sentences(elements))
    ids = checkpointed(strings.withColumn("string_id", scalars.string_id(F.col("string"))))
    return ids.join(possibly_among(known, ids), "string_id", "left_anti")


def ingest(
    spark: SparkSession,
    files: DataFrame,
    root: str,
    batch_id: str,
    *,
    etypes: Iterable[str] = S.BASIC_ETYPES,
    strict: bool = True,
    with_strings: bool = False,
    reiki_only: bool = True,
    check_municipalities: bool = True,
    include_subitem_sentences: bool = False,
    strip_ws: bool = True,
    fold_width: bool = False,
    **checks: bool,
) -> DataFrame:
    """Register ``files`` (``FILES`` rows) and return the outcomes, one row per file.

    A file is registered, skipped (number known already, no ordinance) or an error. With
    ``strict`` one violation anywhere keeps a whole law out; otherwise violations inside a
    law are only reported. Nothing of a batch is visible before its last write, and a batch
    that is already visible is not run again: its own outcomes are returned.

    There is one route, whatever the number of files. The listing is held against the latest state
    of each file; the others are read once, and the bodies of those whose number is new are registered. Outcomes are stored for files that were looked at, not for settled ones.
    """
    warehouse = Warehouse(spark, root)
    if batch_id in warehouse.committed_ids():
        return warehouse.batch("outcomes", batch_id).select(*RESULT)
    batches = warehouse.batches()
    staging = scratch_path(spark, "staging")

    def staged(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{staging}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{staging}/{name}")

    # The listing needs no content.
    read_as = reading(strip_ws, fold_width)
    listing = files.select(*_LISTING, "code")
    settled = settled_files(listing, warehouse.file_states(batches), read_as, reiki_only)
    if batches:
        # Stored, as it is asked for three times and takes a listing and the states of all files.
        settled = staged("settled", settled)
    open_files = staged("open", listing.join(settled.select("path"), "path", "left_anti"))
    condition = time_spans(open_files)
    read_files = files.where(condition)

    # Each file is read and parsed once; all steps below work on this table.
    numbering = {"strip_ws": strip_ws, "fold_width": fold_width}
    if batches:
        read_files = read_files.join(settled.where(condition).select("path"), "path", "left_anti")
    parsed = xml.parse_chunks(
        read_files, etypes=etypes, include_subitem_sentences=include_subitem_sentences, reiki_only=reiki_only, **numbering,
    ).withColumn("law_id", number_id())
    with small_batches(spark):
        parsed = staged("chunks", parsed)

    # Headers, small beside the elements, with a first decision. How deep a body is does not count for it.
    wanted = F.col("parse_error").isNull() & (F.col("is_reiki") if reiki_only else F.lit(True))
    registered = warehouse.table("laws", batches)
    taken = registered.select("muni_id", F.col("num").alias("law_num"), F.lit(True).alias("taken"))
    heads = xml.heads_of(parsed).withColumn("parse_error", F.when(F.col("parse_error") != xml.TOO_DEEP, F.col("parse_error")))
    heads = heads.join(open_files.select("path"), "path", "left_semi").join(taken, ["muni_id", "law_num"], "left")
    heads = staged("heads", heads.withColumn("known", wanted & F.col("taken").isNotNull()).drop("taken"))
    known = heads.where("known").select("path")

    # Bodies of files that can be read and whose number may be new.
    chunks = parsed.where(F.col("parse_error").isNull() | (F.col("parse_error") == xml.TOO_DEEP))
    chunks = chunks.where(F.col("is_reiki") if reiki_only else F.lit(True))
    if batches:
        chunks = chunks.join(known, "path", "left_anti")

    # Violations. Written first: what they exclude is then a table of known size.
    open_heads = heads.where(~F.col("known") & (wanted | F.col("parse_error").isNotNull()))
    municipalities = warehouse.table("municipalities") if check_municipalities else None
    found = validate.violations(
        chunks, open_heads, municipalities,
        include_subitem_sentences=include_subitem_sentences, **checks,
    )
    unreadable = validate.file_errors(xml.heads_of(chunks.where(F.col("parse_error").isNotNull())))
    warehouse.write("errors", batch_id, found.unionByName(unreadable))
    errors = warehouse.batch("errors", batch_id)
    if not strict:
        errors = errors.where(F.col("error_class").isin(*validate.LAW_ERROR_CLASSES))
    failed = errors.select("path").distinct()

    valid = open_heads.where(wanted).join(failed, "path", "left_anti")
    winners = lowest_file(valid)
    checked = staged("winners", _lowest_per_id(winners, registered))
    new = checked.where(~F.col("taken")).select("path")
    if not checked.where("collides").isEmpty():
        collided = winners.join(new, "path", "left_anti").select("path")
        reports = validate.collision_errors(heads.join(collided, "path", "left_semi"))
        warehouse.write("errors", batch_id, reports, mode="append")
        failed = failed.union(collided)

    def mark(rows: DataFrame, outcome: str) -> DataFrame:
        return rows.select("path", F.lit(outcome).alias("mark"))

    marks = mark(known, "skipped_known").union(mark(failed, "error")).union(mark(new, "registered"))
    outcome = (
        F.when(F.col("parse_error").isNotNull(), "error")
        .when(~wanted, "skipped_not_reiki")
        .otherwise(F.coalesce("mark", F.lit("skipped_known")))
    )
    decided = heads.join(marks, "path", "left").withColumn("outcome", outcome)
    decided = decided.withColumns({"reading": F.lit(read_as), "decided_at": F.current_timestamp()})
    warehouse.write("outcomes", batch_id, decided)

    outcomes = warehouse.batch("outcomes", batch_id)
    rejected = outcomes.where(F.col("outcome") != "registered").select("path")
    warehouse.write("laws", batch_id, xml.laws(heads.join(rejected, "path", "left_anti")))
    # A row of many elements is kept or dropped before it becomes as many rows.
    kept = chunks.join(rejected, "path", "left_anti")
    warehouse.write("elements", batch_id, xml.elements(xml.rows_of(kept), "pref_id"))
    written = ["errors", "outcomes", "laws", "elements"]
    if with_strings:
        elements = warehouse.batch("elements", batch_id)
        warehouse.write("strings", batch_id, new_strings(elements, warehouse.table("strings", batches)))
        warehouse.write("string_edges", batch_id, string_rows(elements))
        written += ["strings", "string_edges"]
    warehouse.commit(batch_id, written)
    # The staged copy is not needed any more; writing no rows over it frees the space.
    no_rows(spark, parsed.schema).write.mode("overwrite").parquet(f"{staging}/chunks")
    return outcomes.select(*RESULT).unionByName(settled)


def ingest_tree(spark: SparkSession, corpus: str, root: str, batch_id: str, **options) -> DataFrame:
    """Register every municipality folder below ``corpus``, files in its subfolders included.

    Files that are settled are listed, not opened.
    """
    files = sources.in_municipality(sources.corpus_files(spark, corpus), corpus)
    return ingest(spark, files, root, batch_id, **options)

"""Composed flows over dialogue corpora: clean, then correct.

A dialogue table has an id and three text columns: a short description, the
patient's question and the doctor's reply.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.personal import drop_greeting, mask_stated_name, redact_reply
from gristmill.functions.text import clean_text, computed_once, content_key
from gristmill.operators.dedup import keep_ids
from gristmill.operators.lengths import is_noise, length_caps, long_enough, within_caps
from gristmill.operators.neardup import drop_near_duplicates, near_duplicate_kept_ids
from gristmill.sources.writers import write_parquet
from gristmill.streaming.guards import require_batch


def clean_texts(
    df: DataFrame, cols: tuple[str, ...] = ("description", "patient", "doctor"),
    null_as: str | None = None,
) -> DataFrame:
    """The row-local part of cleaning."""
    return computed_once(df, {c: clean_text(c, null_as) for c in cols})


def _distinct_dialogues(df: DataFrame, id_col: str, null_as: str | None) -> DataFrame:
    """One narrow row per distinct (patient, doctor): first id, lengths, noise flag, copies.

    Lengths and noise depend on the key alone, so every later decision of the
    cleaning flow can be taken on this table; text is only read again for the
    rows that are kept.
    """
    texts = ("patient", "doctor")  # the only columns read here
    keyed = clean_texts(df.select(id_col, *texts), texts, null_as).select(
        content_key("patient", "doctor").alias("_key"), id_col,
        F.length("patient").alias("_p"), F.length("doctor").alias("_d"),
        is_noise("doctor").alias("_noise"),
    )
    return (
        keyed.groupBy("_key")
        .agg(
            F.min(id_col).alias(id_col),
            F.min("_p").alias("_p"), F.min("_d").alias("_d"), F.max("_noise").alias("_noise"),
            F.count(F.lit(1)).alias("_copies"),
        )
        # stated on all columns so that every reader asks for the same ones, which
        # lets Spark run this aggregation once and reuse its shuffle
        .where(F.col(id_col).isNotNull() & F.col("_noise").isNotNull() & (F.col("_copies") > 0))
    )


def _caps(distinct: DataFrame, minimum: int, q: float):
    lengths = {"patient": F.col("_p"), "doctor": F.col("_d")}
    enough = distinct.where(long_enough(list(lengths.values()), minimum))
    return lengths, length_caps(enough, lengths, q)


def clean_dialogues(
    df: DataFrame, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS,
    q: float = fixed.CAP_QUANTILE, null_as: str | None = None, store_drops: bool = False,
) -> DataFrame:
    """Clean texts, keep the first of equal (patient, doctor), then drop short, long, noise.

    The caps come from the rows that survive the length minimum. ``store_drops``
    as in ``keep_ids``.
    """
    require_batch(df, "clean_dialogues")
    distinct = _distinct_dialogues(df, id_col, null_as)
    lengths, caps = _caps(distinct, minimum, q)
    kept = distinct.where(
        long_enough(list(lengths.values()), minimum) & within_caps(lengths, caps) & ~F.col("_noise")
    )
    return clean_texts(keep_ids(df, kept.select(id_col), id_col, store_drops), null_as=null_as)


def clean_ledger(
    df: DataFrame, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS,
    q: float = fixed.CAP_QUANTILE, null_as: str | None = None,
) -> DataFrame:
    """(drop_reason, n_rows, pct_of_input) of ``clean_dialogues``; the reasons sum to the input."""
    require_batch(df, "clean_ledger")
    distinct = _distinct_dialogues(df, id_col, null_as)
    lengths, caps = _caps(distinct, minimum, q)
    reason = (
        F.when(~long_enough(list(lengths.values()), minimum), "too_short")
        .when(~within_caps(lengths, caps), "too_long")
        .when(F.col("_noise"), "noise")
        .otherwise("kept")
    )
    by_reason = distinct.groupBy(reason.alias("drop_reason")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_copies") - 1).alias("again")
    )
    # four rows at most from here on
    wide = by_reason.agg(
        *[F.sum(F.when(F.col("drop_reason") == r, F.col("n"))).alias(r)
          for r in ("too_short", "too_long", "noise", "kept")],
        F.sum("again").alias("duplicate"), F.sum(F.col("n") + F.col("again")).alias("total"),
    )
    return ledger_rows(wide, ("duplicate", "too_short", "too_long", "noise", "kept"))


_REASONS = ("duplicate", "too_short", "too_long", "noise", "kept")


def clean_and_count(
    df: DataFrame, path: str, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS,
    q: float = fixed.CAP_QUANTILE, null_as: str | None = None,
) -> DataFrame:
    """Writes ``clean_dialogues`` to ``path`` as Parquet and returns its ledger, counted by that write.

    The drop reasons are observed (``DataFrame.observe``) on the narrow table of
    distinct dialogues as the write reads it, so the ledger costs no pass of its
    own over the texts. Same rows as ``clean_ledger``. A stage that Spark runs
    again after a lost executor may count its rows again; the ledger is then
    refused rather than reported wrong: its reasons must add up to the rows written
    plus those dropped.
    """
    require_batch(df, "clean_and_count")
    distinct = _distinct_dialogues(df, id_col, null_as)
    lengths, caps = _caps(distinct, minimum, q)
    reason = (
        F.when(~long_enough(list(lengths.values()), minimum), "too_short")
        .when(~within_caps(lengths, caps), "too_long")
        .when(F.col("_noise"), "noise")
        .otherwise("kept")
    )
    seen = Observation("clean_ledger")
    observed = distinct.withColumn("_reason", reason).observe(
        seen,
        *[F.count_if(F.col("_reason") == r).alias(r) for r in _REASONS[1:]],
        F.sum(F.col("_copies") - 1).alias("duplicate"), F.sum("_copies").alias("total"),
    )
    kept = observed.where(F.col("_reason") == "kept").select(id_col)
    write_parquet(clean_texts(keep_ids(df, kept, id_col), null_as=null_as), path)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    if sum(counts[r] for r in _REASONS) != counts["total"]:
        raise RuntimeError(f"ledger does not add up: {counts}")
    spark = df.sparkSession
    wide = spark.createDataFrame([tuple(counts[r] for r in (*_REASONS, "total"))],
                                 ", ".join(f"{r} long" for r in (*_REASONS, "total")))
    return ledger_rows(wide, _REASONS)


def ledger_rows(wide: DataFrame, reasons: tuple[str, ...]) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(r).alias("drop_reason"), F.coalesce(F.col(r), F.lit(0)).alias("n_rows"))
        for r in reasons
    ])
    return wide.select("total", F.explode(entries).alias("e")).select(
        "e.drop_reason", "e.n_rows",
        F.when(F.col("total") > 0, 100.0 * F.col("e.n_rows") / F.col("total")).alias("pct_of_input"),
    )


def redact_dialogues(df: DataFrame) -> DataFrame:
    """The row-local part of the corrections: reply redaction, name mask, web greeting."""
    return computed_once(df, {
        "doctor": redact_reply("doctor"),
        "patient": drop_greeting(mask_stated_name("patient")),
    })


def correct_dialogues(
    df: DataFrame, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS,
    store_drops: bool = False,
) -> DataFrame:
    """Corrections of a cleaned corpus.

    Near-duplicates are those of the patient text as it comes in, before names
    and greetings are taken out; then redaction, then the length minimum again.
    """
    require_batch(df, "correct_dialogues")
    redacted = redact_dialogues(drop_near_duplicates(df, "patient", id_col, store_drops=store_drops))
    return redacted.where(long_enough([F.length("patient"), F.length("doctor")], minimum))


def correct_ledger(
    df: DataFrame, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS
) -> DataFrame:
    """(drop_reason, n_rows, pct_of_input) of ``correct_dialogues``."""
    require_batch(df, "correct_ledger")
    kept = near_duplicate_kept_ids(df, "patient", id_col).withColumn("_first", F.lit(True))
    state = redact_dialogues(df).select(
        id_col, long_enough([F.length("patient"), F.length("doctor")], minimum).alias("_long")
    )
    first = F.coalesce("_first", F.lit(False))
    wide = state.join(kept, id_col, "left").agg(
        F.count_if(~first).alias("near_duplicate"),
        F.count_if(first & ~F.col("_long")).alias("too_short"),
        F.count_if(first & F.col("_long")).alias("kept"),
        F.count(F.lit(1)).alias("total"),
    )
    return ledger_rows(wide, ("near_duplicate", "too_short", "kept"))


def _store(df: DataFrame, path: str) -> DataFrame:
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_cleaned(df: DataFrame, path: str, id_col: str = "row_id") -> DataFrame:
    """The cleaned corpus, written to ``path`` (shared storage) and read again."""
    return _store(clean_dialogues(df, id_col, store_drops=True), path)


def run_stages(df: DataFrame, path: str, id_col: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Clean, store, correct, store; returns the two stored tables.

    Correction reads its input more than once, so the cleaned corpus is written
    below ``path`` instead of being computed again or held in memory.
    """
    cleaned = store_cleaned(df, f"{path}/cleaned", id_col)
    return cleaned, _store(correct_dialogues(cleaned, id_col, store_drops=True), f"{path}/corrected")


ROWS_PER_BUCKET = 1_000_000  # buckets of a stored stage: at least the session's shuffle partitions


def store_bucketed(df: DataFrame, name: str, id_col: str = "row_id", buckets: int | None = None) -> DataFrame:
    """``df`` saved as a table of the session's warehouse, bucketed and sorted by ``id_col``, and read again.

    A later join on the id finds this side already dealt by the id, so only the
    other side (an id list, usually) is shuffled to match.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)
    return spark.table(name)


def run_stages_bucketed(
    df: DataFrame, prefix: str, id_col: str = "row_id", minimum: int = fixed.MIN_CHARS
) -> tuple[DataFrame, DataFrame]:
    """``run_stages`` with both stages stored as bucketed tables ``<prefix>_cleaned`` and ``<prefix>_corrected``.

    The number of buckets follows the rows (``ROWS_PER_BUCKET`` a bucket, the
    session's shuffle partitions at least). Correction's id joins then leave the
    cleaned texts where they are: the texts move once, when they are cleaned.
    """
    require_batch(df, "run_stages_bucketed")
    spark = df.sparkSession
    rows = df.agg(F.count(F.lit(1))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BUCKET))
    cleaned = store_bucketed(clean_dialogues(df, id_col), f"{prefix}_cleaned", id_col, buckets)
    corrected = correct_dialogues(cleaned, id_col, minimum)
    return cleaned, store_bucketed(corrected, f"{prefix}_corrected", id_col, buckets)

"""Source divergence audit: how far each source's term distribution lies from the others'.

Terms are runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` (ASCII letters and every
non-ASCII character), with A-Z lower-cased. NULL text, lang and source read as
''. Each lang keeps the ``V`` terms found in at least ``min_docs`` of its rows.

For a group (lang, source) and a kept term with ``count`` occurrences there,
``p = 1 + floor(10^9 * (count + 2) / (N + 2V))``, ``N`` the group's occurrences
of kept terms; the lang as a whole gives ``q`` by the same rule. Two values
compare by ``f = floor((p - q)^2 / (p + q))``, all in exact integers.

* part ``pair``: for each other source of the lang, the sum of ``f`` over all
  kept terms (0 when ``V`` is 0); every rank.
* part ``term``: for each kept term of the group with count > 0 and ``p > q``
  (q the lang's), ``f``; the ``top`` best.

Ranks count from 1 per (lang, source, part), value descending, then item in
UTF-8 order.

The texts are read once: each Arrow batch is lowered (A-Z), split between
terms and grouped per (lang, source, term) into occurrences and rows holding the
term, in Arrow's own kernels; Spark combines the batches in each task before the
shuffle and stores the result.

The ``term`` part runs as a dominance skyband: within a group, a term with a
higher (or equal) count, a lower (or equal) lang count and an earlier spelling
has an ``f`` at least as high and comes first on ties, so a term that ``top``
others dominate cannot rank. Terms with equal count and lang count are cut to
their ``top`` earliest first (a row limit per cell that Spark applies in each
task before the shuffle). Each task keeps, per group, the terms that fewer
than ``top`` of its own terms dominate; the kept sets merge and are ranked
exactly. A hot group's terms are spread over all tasks by the hash of the term.

The ``pair`` part sums only over terms that one of the two sources holds and
adds the terms that neither holds as ``f`` of the two sources' ``p`` at count 0
times their number. Terms both hold meet by (lang, term); a term one source
holds is priced, for every other source of its lang, against that source's
``p`` at count 0 (a broadcast of the sources), and the terms both hold are
taken out of that sum again. Both sums are combined in each task before their
shuffle, so what moves is one row per pair of sources and task. The work is
the (source, term) rows times the sources of their lang, which the output, all
pairs of sources, squares anyway.

Defined results: groups without terms pair with the other sources of their
lang; a lang with one source gives no pairs; an empty table gives no rows.
Extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.components import BROADCAST_IDS, stored

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms_of(text: Column) -> Column:
    """The terms of a text, in order, repeats kept (empty for NULL)."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TERM), F.lit(0))
    return F.transform(found, lambda t: F.translate(t, _UPPER, _LOWER))


def _div(a: Column, b: Column) -> Column:
    """Integral division, NULL for a zero divisor."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def level(count: Column, total: Column, vocabulary: Column) -> Column:
    """``1 + floor(10^9 * (count + 2) / (total + 2 * vocabulary))`` in exact decimals (NULL if V is 0)."""
    top = F.lit(SCALE).cast("decimal(38,0)") * (count + 2).cast("decimal(38,0)")
    return (F.lit(1) + _div(top, (total + 2 * vocabulary).cast("decimal(38,0)"))).cast("long")


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; p and q are positive."""
    return _div((p - q) * (p - q), p + q).cast("long")


def _sized(df: DataFrame) -> DataFrame:
    """Sent to every executor if it has at most ``BROADCAST_IDS`` rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def _skyband(top: int):
    """Per task and group: the rows that fewer than ``top`` rows of the task dominate."""
    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, counts, langs, terms = None, [], np.empty(0, np.int64), np.empty(0, object)
        for frame in frames:
            picked = np.zeros(len(frame), bool)
            keys = list(zip(frame["lang"], frame["source"]))
            for i, (key, lang_count, term) in enumerate(zip(keys, frame["lang_count"], frame["term"])):
                if key != group:
                    group, langs, terms = key, np.empty(0, np.int64), np.empty(0, object)
                if len(langs) >= top and int(((langs <= lang_count) & (terms < term)).sum()) >= top:
                    continue
                picked[i] = True
                langs, terms = np.append(langs, lang_count), np.append(terms, term)
            yield frame[picked]

    return keep


_SPLIT = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # what lies between terms


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, count, rows) of each Arrow batch, in Arrow's kernels: A-Z lowered, split, grouped."""
    for batch in batches:
        parts = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(batch.column("text"), "")), pattern=_SPLIT)
        terms, rows = pc.list_flatten(parts), pc.list_parent_indices(parts)
        keep = pc.not_equal(terms, "")
        terms, rows = terms.filter(keep), rows.filter(keep)
        table = pa.table({"row": rows, "lang": batch.column("lang").take(rows),
                          "source": batch.column("source").take(rows), "term": terms})
        per_row = table.group_by(["row", "lang", "source", "term"]).aggregate([("term", "count")])
        grouped = per_row.group_by(["lang", "source", "term"]).aggregate(
            [("term_count", "sum"), ("term_count", "count")]
        )
        yield pa.RecordBatch.from_arrays(
            [grouped["lang"].combine_chunks(), grouped["source"].combine_chunks(), grouped["term"].combine_chunks(),
             grouped["term_count_sum"].combine_chunks().cast(pa.int64()),
             grouped["term_count_count"].combine_chunks().cast(pa.int64())],
            ["lang", "source", "term", "count", "rows"],
        )


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``; see the module's notes."""
    base = docs.select(
        F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
        F.coalesce(F.col("source"), F.lit("")).alias("source"),
        F.col("text"),
    )
    groups = stored(base.select("lang", "source").distinct(), "groups")
    # one pass over the texts: each task counts terms and rows holding them per group, combined before the shuffle
    counted = base.mapInArrow(_count_terms, "lang string, source string, term string, count long, rows long")
    stats = stored(counted.groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("rows").alias("rows")
    ), "term-stats")
    kept = stats.groupBy("lang", "term").agg(F.sum("rows").alias("rows")) \
        .where(F.col("rows") >= min_docs).select("lang", "term")
    counts = stored(stats.join(kept, ["lang", "term"]).select("lang", "source", "term", "count"), "term-counts")
    vocab = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("N"))
    sized = _sized(stored(
        groups.join(totals, ["lang", "source"], "left").join(vocab, "lang", "left")
        .select("lang", "source", F.coalesce("N", F.lit(0)).alias("N"), F.coalesce("V", F.lit(0)).alias("V")),
        "group-sizes",
    ))
    by_lang = counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"))
    lang_sizes = _sized(by_lang.groupBy("lang").agg(F.sum("lang_count").alias("LN")).join(vocab, "lang"))
    levels = stored(
        counts.join(sized, ["lang", "source"]).withColumn("p", level(F.col("count"), F.col("N"), F.col("V"))),
        "term-levels",
    )

    # part term: skyband per task, then exact ranks on what is left
    lang_levels = by_lang.join(lang_sizes, "lang").withColumn(
        "q", level(F.col("lang_count"), F.col("LN"), F.col("V"))
    ).select("lang", "term", "lang_count", "q")
    rising = levels.join(lang_levels, ["lang", "term"]).where("p > q") \
        .select("lang", "source", "term", "count", "lang_count", "p", "q")
    # terms of a group with equal count and lang count tie in value: the top earliest of them dominate the rest
    cell = Window.partitionBy("lang", "source", "count", "lang_count").orderBy("term")
    rising = rising.withColumn("_nth", F.row_number().over(cell)).where(F.col("_nth") <= top).drop("_nth")
    band = rising.sortWithinPartitions("lang", "source", F.desc("count"), "lang_count", "term") \
        .mapInPandas(_skyband(top), rising.schema)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = band.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                        gap(F.col("p"), F.col("q")).alias("value")) \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    # part pair: terms both sources hold meet by (lang, term); terms one source holds are priced against the
    # other's level at count 0 for every partner, summed before the shuffle; the rest is counted
    others = sized.select("lang", F.col("source").alias("item"), F.col("N").alias("N2"), F.col("V").alias("V2"),
                          level(F.lit(0), F.col("N"), F.col("V")).alias("z2"))
    pairs = sized.join(others, "lang").where("source <> item")
    partners = _sized(pairs.select("lang", "source", "item", "z2"))
    mine = levels.select("lang", "source", "term", "p")
    theirs = levels.select("lang", F.col("source").alias("item"), "term", F.col("p").alias("p2"))
    both = stored(mine.join(theirs, ["lang", "term"]).where("source <> item").join(
        partners, ["lang", "source", "item"]
    ).groupBy("lang", "source", "item").agg(
        F.sum(gap(F.col("p"), F.col("p2"))).alias("sum_both"),
        F.sum(gap(F.col("p"), F.col("z2"))).alias("held_a"), F.count(F.lit(1)).alias("n_both"),
    ), "pair-both")
    # terms of one source with equal counts share p: priced once per partner
    same_p = levels.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("k"))
    alone = same_p.join(partners, ["lang", "source"]).groupBy("lang", "source", "item").agg(
        F.sum(F.col("k") * gap(F.col("p"), F.col("z2"))).alias("all_a"), F.sum("k").alias("n_a")
    )
    back = alone.select("lang", F.col("source").alias("item"), F.col("item").alias("source"),
                        F.col("all_a").alias("all_b"), F.col("n_a").alias("n_b"))
    back_both = both.select("lang", F.col("source").alias("item"), F.col("item").alias("source"),
                            F.col("held_a").alias("held_b"))
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    rest = F.col("V") - z("n_a") - z("n_b") + z("n_both")
    zero = gap(level(F.lit(0), F.col("N"), F.col("V")), level(F.lit(0), F.col("N2"), F.col("V2")))
    value = F.when(F.col("V") == 0, F.lit(0)).otherwise(
        z("sum_both") + z("all_a") - z("held_a") + z("all_b") - z("held_b") + rest * zero
    )
    keys = ["lang", "source", "item"]
    valued = pairs.join(both, keys, "left").join(alone, keys, "left").join(back, keys, "left") \
        .join(back_both, keys, "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))
    ranked = valued.withColumn("rank", F.row_number().over(order))
    return ranked.unionByName(terms.select(*ranked.columns))

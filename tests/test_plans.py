"""What the physical plans may and may not hold, and which operators a stream may pass."""

import re

import pytest
from pyspark.sql import functions as F

from checks.catalog import catalog
from gristmill import functions as fn
from gristmill.operators import conversations, dedup, lengths, neardup, profile, ranks, validation
from gristmill.plans import dialogues, instructions
from gristmill.sources import planted

SF = "/root/testdata/sf0.001"
LAZY = [
    "profile_lengths", "dup_counts", "clean_text_docs", "exact_dedup_docs", "cap_lengths",
    "clean_dialogues", "retention_ledger", "pii_report", "redact_reply", "near_dup_drops",
    "coherence_rows", "split_assign", "sample_exact", "filters_strict", "validation_stats", "history",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_row_python_no_cross_join(spark, name):
    text = plan(catalog()[name](spark, SF))
    assert "BatchEvalPython" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if not name.startswith("near_dup"):
        assert "ArrowEvalPython" not in text


def test_deduplication_shuffles_keys_and_combines_first(spark):
    text = plan(dedup.first_ids(planted.table(spark, SF, "documents"), ["text"], "doc_id"))
    exchange = text.index("Exchange hashpartitioning")
    assert "partial_min" in text[exchange:]
    assert text.count("FileScan") == 1


def test_a_short_drop_list_moves_no_text(spark, monkeypatch):
    rows = planted.table(spark, SF, "documents")
    df = neardup.drop_near_duplicates(rows, "text", "doc_id", store_drops=True)
    text = plan(df)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text
    assert "Exchange hashpartitioning" not in text
    lazy = neardup.drop_near_duplicates(rows, "text", "doc_id")
    assert sorted(r.doc_id for r in df.collect()) == sorted(r.doc_id for r in lazy.collect())
    monkeypatch.setattr(dedup, "BROADCAST_IDS", 0)
    beyond = neardup.drop_near_duplicates(rows, "text", "doc_id", store_drops=True)
    assert "ShuffledHashJoin" in plan(beyond) and "Sort " not in plan(beyond)
    assert beyond.count() == lazy.count()


def test_keeping_ids_sorts_no_text(spark):
    rows = planted.table(spark, SF, "documents")
    text = plan(dedup.drop_duplicates(rows, ["text"], "doc_id"))
    assert "ShuffledHashJoin" in text and "Sort " not in text


def test_flags_are_evaluated_once(spark, tmp_path):
    """One flagged scan for the decisions, one for the survivors' texts."""
    planted.conv(spark, SF).write.parquet(str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "c"))
    for text in (plan(instructions.apply_filters(rows)), plan(instructions.apply_filters(rows, True))):
        assert text.count("FileScan") == 2
        assert text.count("partial_max(sensitive") == 1


def test_cleaning_keys_read_only_the_key_columns(spark, tmp_path):
    planted.dialogues(spark, SF).write.parquet(str(tmp_path / "d"))
    stored = spark.read.parquet(str(tmp_path / "d"))
    schemas = re.findall(r"ReadSchema: (\S+)", plan(dialogues.clean_dialogues(stored)))
    assert sum("description" in s for s in schemas) == 1


def test_reports_read_once(spark):
    for df in (
        catalog()["pii_flags_docs"](spark, SF),
        catalog()["pattern_counts"](spark, SF),
        profile.describe_lengths(planted.table(spark, SF, "documents"), ["text", "lang"]),
        catalog()["near_dup_drops"](spark, SF),
    ):
        limit = 2 if "ArrowEvalPython" in plan(df) else 1
        assert plan(df).count("FileScan") <= limit


def test_near_duplicate_drops_read_ids_alone_the_second_time(spark):
    df = neardup.near_duplicate_drops(planted.table(spark, SF, "documents"), "text", "doc_id")
    schemas = re.findall(r"ReadSchema: (\S+)", plan(df))
    assert set(schemas) == {"struct<doc_id:bigint>", "struct<doc_id:bigint,text:string>"}


def test_split_assignment_moves_no_rows(spark):
    """Only the cut-point subquery holds exchanges; the rows themselves stay in place."""
    rows = planted.table(spark, SF, "documents").withColumnRenamed("doc_id", "row_id")
    text = plan(ranks.assign_three_way_split(rows))
    main = "\n".join(
        line for line in text.split("\n") if "Subquery" not in line
    ).split("Initial Plan")[-1]
    assert text.split("Subquery")[0].count("Exchange") == 0, main


def test_history_shuffles_text_once(spark):
    text = plan(conversations.conversation_history(planted.table(spark, SF, "conversations")))
    carrying = [line for line in text.split("\n") if "Exchange" in line]
    assert len(carrying) <= 4


def test_redaction_is_evaluated_once(spark):
    rows = spark.createDataFrame(
        [(1, "d", "p" * 40, "q" * 40)], "row_id bigint, description string, patient string, doctor string"
    ).repartition(2)
    df = dialogues.redact_dialogues(rows).where(F.length("doctor") >= 30)
    assert plan(df).count("[NAME]") == 1


def test_caps_reuse_the_deduplication_shuffle(spark):
    df = catalog()["clean_dialogues"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan(df)


GLOBAL = {
    "drop_duplicates": lambda d: dedup.drop_duplicates(d, ["text"], "doc_id"),
    "cap_lengths": lambda d: lengths.cap_lengths(d, ["text"]),
    "drop_near_duplicates": lambda d: neardup.drop_near_duplicates(d, "text", "doc_id"),
    "sample_exact": lambda d: ranks.sample_exact(d, 5, id_col="doc_id"),
    "shape": profile.shape,
    "describe_lengths": lambda d: profile.describe_lengths(d, ["text"]),
    "clean_dialogues": dialogues.clean_dialogues,
    "apply_filters": instructions.apply_filters,
}


@pytest.mark.parametrize("name", sorted(GLOBAL))
def test_whole_corpus_operators_refuse_a_stream(spark, name):
    stream = spark.readStream.schema("doc_id bigint, text string").parquet(SF)
    with pytest.raises(ValueError, match=f"{name} needs the whole corpus"):
        GLOBAL[name](stream)


def test_row_local_operators_pass_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(1, "<b>Dr. Jane Doe</b>  invests", "x" * 40), (2, "hi", "short")]
    spark.createDataFrame(rows, "row_id bigint, instruction string, output string").write.parquet(source)
    stream = spark.readStream.schema("row_id bigint, instruction string, output string").parquet(source)
    out = lengths.min_length(stream, ["output"]).withColumn("clean", fn.redact_reply(fn.clean_text("instruction")))
    out = validation.with_flags(out)
    query = (
        out.select("row_id", "clean", "on_topic").writeStream.format("memory").queryName("passed")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert [tuple(r) for r in spark.table("passed").collect()] == [(1, "invests", True)]


def test_ledger_counted_by_the_write(spark, tmp_path):
    from gristmill.plans import dialogues as flows
    from gristmill.sources import planted as pl

    rows = pl.dialogues(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "cleaned")
    ledger = sorted(tuple(r) for r in flows.clean_and_count(rows, path).collect())
    assert ledger == sorted(tuple(r) for r in flows.clean_ledger(rows).collect())
    written = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert written == sorted(tuple(r) for r in flows.clean_dialogues(rows).collect())


def _exchanges_above(plan: str, marker: str) -> list[str]:
    """Exchange nodes on the path from each line holding ``marker`` up to the nearest join."""
    lines = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" +-:")) for line in lines]
    found = []
    for i, line in enumerate(lines):
        if marker not in line:
            continue
        level = depth[i]
        for j in range(i - 1, -1, -1):
            if depth[j] < level:
                level = depth[j]
                if "Join" in lines[j]:
                    break
                if "Exchange" in lines[j]:
                    found.append(lines[j].strip())
    return found


def test_bucketed_stages_move_the_text_once(spark):
    import uuid

    from gristmill.plans import dialogues as flows
    from gristmill.sources import planted as pl

    rows = pl.dialogues(spark, SF)
    prefix = "t_" + uuid.uuid4().hex
    cleaned = flows.store_bucketed(flows.clean_dialogues(rows), f"{prefix}_cleaned")
    corrected = flows.correct_dialogues(cleaned)
    plan = corrected._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if f"{prefix}_cleaned" in line and "doctor" in line]
    assert scans and not _exchanges_above(plan, f"{prefix}_cleaned")
    _, stored = flows.run_stages_bucketed(rows, prefix + "x")
    want = flows.run_stages(rows, str(spark.conf.get("spark.checkpoint.dir")) + "/" + prefix)[1]
    assert sorted(tuple(r) for r in stored.collect()) == sorted(tuple(r) for r in want.collect())

"""Line dedup, conversation prefix trie and source divergence against plain Python versions."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gristmill.llm import line_bloom, prefix_trie, queries, skyband

BLANKS = " \t\n\x0b\x0c\r"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_lines(rows, min_chars=40, min_docs=5):
    """{row index: (n_lines, n_dropped, kept_sha256)}."""
    split = [(i, d, (t or "").split("\n")) for i, (d, t) in enumerate(rows)]
    holders = defaultdict(set)
    for _, d, lines in split:
        for line in lines:
            key = line.strip(BLANKS).translate(FOLD)
            if len(key) >= min_chars and d is not None:
                holders[key].add(d)
    frequent = {k: max(ds) for k, ds in holders.items() if len(ds) >= min_docs}
    out = {}
    for i, d, lines in split:
        kept = [l for l in lines if not (l.strip(BLANKS).translate(FOLD) in frequent
                                         and frequent[l.strip(BLANKS).translate(FOLD)] != d)]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


SHARED = "  The Same Long Line Shared Across Many Documents Here  "
LINE_ROWS = [
    (1, f"a\n{SHARED}\nb"), (2, f"{SHARED.lower()}\n\nc"), (3, f"x\n\t{SHARED}"), (4, SHARED + "\n" + SHARED),
    (None, SHARED), (5, f"{SHARED}\ny"), (5, f"{SHARED}\ny"), (6, None), (7, ""), (8, "\n\n"),
    (9, "another long line that appears in only three documents ok"),
    (10, "another long line that appears in only three documents ok"),
    (11, "another long line that appears in only three documents ok\n" + "w " * 20_000),
    (12, "short\nshort\nshort"), (13, "short"), (14, "short"), (15, "short"), (16, "short"),
]


def test_line_dedup_against_plain(spark):
    df = spark.createDataFrame(LINE_ROWS, "doc_id long, text string").withColumn("line_dedup", F.lit("clash")) \
        .withColumn("n_lines", F.lit(-1))
    got = line_bloom.drop_frequent_lines(df).collect()
    want = plain_lines(LINE_ROWS)
    assert [r.doc_id for r in got] and len(got) == len(LINE_ROWS)
    assert line_bloom.drop_frequent_lines(df).columns == ["doc_id", "text", "n_lines", "line_dedup"]
    seen = Counter()
    for r in got:
        text = r.text
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        seen[(r.doc_id, r.line_dedup.n_lines, r.line_dedup.n_dropped, digest)] += 1
        assert r.n_lines == -1
    assert seen == Counter((d, *want[i]) for i, (d, _) in enumerate(LINE_ROWS))
    # the keeper is the largest id; the NULL id loses its copy
    by_id = {r.doc_id: r for r in got}
    assert by_id[5].line_dedup.n_dropped == 0 and by_id[4].line_dedup.n_dropped == 2
    assert by_id[None].line_dedup.n_dropped == 1


def test_line_dedup_filter_sizes_do_not_change_results(spark, monkeypatch):
    df = spark.createDataFrame(LINE_ROWS * 3, "doc_id long, text string")
    big = {r.doc_id: r.text for r in line_bloom.drop_frequent_lines(df).collect()}
    monkeypatch.setattr(line_bloom, "LEAST_BITS", 8)
    monkeypatch.setattr(line_bloom, "BITS_PER_KEY", 1)
    monkeypatch.setattr(line_bloom, "CHUNK_BITS", 8)
    small = {r.doc_id: r.text for r in line_bloom.drop_frequent_lines(df.repartition(5)).collect()}
    assert big == small


def test_line_dedup_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert line_bloom.drop_frequent_lines(df).count() == 0


def test_line_dedup_query_on_sf(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = Counter((d, *v) for (d, _), v in zip(rows, plain_lines(rows).values()))
    got = Counter(tuple(r) for r in queries.op11_line_bloom(spark, sf).collect())
    assert got == want


def plain_trie(rows):
    """Per node: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn if turn is not None else 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(ts)] for c, ts in turns.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)  # the remainder keeps the sign of c, as in SQL
        seqs[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for key in members:
        if key:
            children[key[:-1]].append(key)

    def subtree(key):
        leaves = 0 if children[key] else 1
        saved = (len(members[key]) - 1) * (len(key[-1][1]) if key else 0)
        for child in children[key]:
            a, b = subtree(child)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = set()
    for key, convs in members.items():
        ends = sorted(c for c in convs if len(seqs[c]) == len(key))
        leaves, saved = subtree(key)
        out.add((min(convs), len(key), min(members[key[:-1]]) if key else None, len(convs), len(children[key]),
                 leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


CONV_ROWS = [
    (100, 0, "user", "hi"), (100, 1, "assistant", "hello"), (100, 2, "user", "bye"),
    (101, 0, "user", "hi"), (101, 1, "assistant", "other"), (101, None, None, "first"),
    (102, 1, "user", "x"), (102, 1, "user", "x"), (103, 5, None, None), (199, 0, "user", "a" * 5000),
    (250, 0, "user", "alone"), (None, 0, "user", "lost"), (-5, 0, "user", "neg"), (0, 0, "user", "zero"),
    (7, 0, "user", "seven"), (7, 1, "assistant", "reply"), (8, 0, "user", "seven"),
]


def test_trie_against_plain(spark):
    df = spark.createDataFrame(CONV_ROWS, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit(9))
    got = {tuple(r) for r in prefix_trie.prefix_trie(df).collect()}
    assert got == plain_trie(CONV_ROWS)


def test_trie_query_on_sf(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {tuple(r) for r in queries.op12_prefix_trie(spark, sf).collect()}
    assert got == plain_trie(rows)


def test_trie_wide_parent_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPLIT", 2)
    rows = [(c, 0, "user", f"t{c % 7}") for c in range(300, 340)] + [(c, 1, "assistant", f"r{c}") for c in range(300, 340)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert {tuple(r) for r in prefix_trie.prefix_trie(df).collect()} == plain_trie(rows)


def test_trie_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.prefix_trie(df).count() == 0


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, min_docs=10, top=10):
    docs = [((l or ""), (s or ""), [t.translate(FOLD) for t in TERM.findall(x or "")]) for x, l, s in rows]
    df = Counter()
    for lang, _, ts in docs:
        for t in set(ts):
            df[lang, t] += 1
    kept = defaultdict(set)
    for (lang, t), n in df.items():
        if n >= min_docs:
            kept[lang].add(t)
    counts, groups = defaultdict(Counter), set()
    for lang, src, ts in docs:
        groups.add((lang, src))
        counts[lang, src].update(t for t in ts if t in kept[lang])
    out = set()

    def levels(c, lang):
        n, v = sum(c.values()), len(kept[lang])
        return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept[lang]}

    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, src in groups:
        mine = levels(counts[lang, src], lang)
        whole = Counter()
        for (l2, s2), c in counts.items():
            if l2 == lang:
                whole.update(c)
        q = levels(whole, lang)
        pairs = []
        for l2, s2 in groups:
            if l2 == lang and s2 != src:
                other = levels(counts[l2, s2], lang)
                pairs.append((s2, sum(f(mine[t], other[t]) for t in kept[lang])))
        terms = [(t, f(mine[t], q[t])) for t in kept[lang] if counts[lang, src][t] > 0 and mine[t] > q[t]]
        for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for rank, (item, value) in enumerate(items[:limit], 1):
                out.add((lang, src, part, item, value, rank))
    return out


def test_divergence_against_plain(spark):
    words = ["alpha", "Beta", "gamma", "délta", "ZETA", "eta", "theta", "iota", "kappa", "lambda", "mu", "nu"]
    rows = []
    for i in range(120):
        text = " ".join(words[(i * k) % len(words)] for k in range(1, 2 + i % 9)) + f" 42x{i % 3}"
        rows.append((text, ["en", "de", None][i % 3], ["s1", "s2", None, "s3"][i % 4]))
    rows += [(None, "en", "s9"), ("", "en", "s1"), ("x " * 10_000, None, "s1"), (rows[0][0], "en", "s1")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("part", F.lit(1))
    got = {tuple(r) for r in skyband.divergence(df, top=3).collect()}
    assert got == plain_divergence(rows, top=3)


def test_divergence_query_on_sf(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang", "source").collect()]
    got = {tuple(r) for r in queries.op13_skyband(spark, sf).collect()}
    assert got == plain_divergence(rows)


def test_divergence_without_kept_terms(spark):
    df = spark.createDataFrame([("a", "en", "s1"), ("b", "en", "s2"), ("c", "de", "s1")], "text string, lang string, source string")
    got = sorted(tuple(r) for r in skyband.divergence(df).collect())
    assert got == [("en", "s1", "pair", "s2", 0, 1), ("en", "s2", "pair", "s1", 0, 1)]
    assert skyband.divergence(df.limit(0)).count() == 0


def test_skyband_keeps_every_top_term():
    import pandas as pd

    rows = pd.DataFrame({"lang": ["en"] * 6, "source": ["s"] * 6, "term": list("abcdef"),
                         "count": [9, 9, 8, 8, 7, 1], "lang_count": [1, 2, 1, 5, 1, 9]})
    rows = rows.sort_values(["count", "lang_count", "term"], ascending=[False, True, True])
    kept = pd.concat(skyband._skyband(2)(iter([rows])))
    # d is dominated by a, b and c; e by a and c; f by all
    assert set(kept.term) == {"a", "b", "c"}

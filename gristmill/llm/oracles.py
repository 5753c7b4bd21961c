"""DuckDB twins of those queries that SQL can express over whole tables."""

from __future__ import annotations

_DRAW = "('0x' || substr(md5('{0}:' || coalesce(doc_id::VARCHAR, '')), {1}, 8))::UBIGINT / 4294967296.0"


def _mix() -> str:
    """Targets by running sums, then the draw of sixteen that comes nearest to them."""
    draws = [_DRAW.format(s // 4, 8 * (s % 4) + 1) for s in range(16)]
    sums = ",\n".join(
        f"sum(CASE WHEN {d} < rate - floor(rate) THEN size ELSE 0 END) AS s{k}" for k, d in enumerate(draws)
    )
    missed = ", ".join(
        f"{{'miss': abs(floor(rate) * source_size + s{k} - target), 'seed': {k}}}" for k in range(16)
    )
    picked = "\n".join(f"WHEN {k} THEN {d}" for k, d in enumerate(draws))
    return f"""
    WITH sized AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
      FROM documents),
    named AS (
      SELECT source, sum(size)::DOUBLE AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
          WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
      FROM sized GROUP BY source),
    levels AS (
      SELECT *, 2 * source_size AS cap,
        (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER (
           ORDER BY 2 * source_size / weight, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM named),
    final AS (SELECT min_by(level, cap / weight) AS level FROM levels WHERE cap > level * weight),
    rates AS (
      SELECT source, source_size,
        CASE WHEN cap <= l.level * weight THEN cap ELSE f.level * weight END AS target,
        CASE WHEN source_size > 0 THEN
          (CASE WHEN cap <= l.level * weight THEN cap ELSE f.level * weight END) / source_size
        ELSE 0 END AS rate
      FROM levels l, final f),
    joined AS (
      SELECT d.*, r.source_size, r.target, r.rate
      FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
    drawn AS (
      SELECT source, source_size, target, rate, {sums}
      FROM joined GROUP BY source, source_size, target, rate),
    chosen AS (SELECT source, (least({missed})).seed AS seed FROM drawn)
    SELECT doc_id, size, source_size::BIGINT AS source_size, target,
      (size * (floor(rate) + CASE WHEN (CASE seed {picked} END) < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM joined j JOIN chosen c ON j.source IS NOT DISTINCT FROM c.source"""


_LINES = r"""
    WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents),
    l AS (
      SELECT doc_id, t, unnest(string_split(t, chr(10))) AS line,
        generate_subscripts(string_split(t, chr(10)), 1) AS pos
      FROM d),
    k AS (
      SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
    f AS (
      SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    m AS (
      SELECT k.doc_id, k.t, k.pos, k.line,
        f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.keeper AS lost
      FROM k LEFT JOIN f ON k.key = f.key),
    r AS (
      SELECT doc_id, t, count(*)::BIGINT AS n_lines, sum(lost::INT)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(CASE WHEN NOT lost THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
      FROM m GROUP BY doc_id, t)
    SELECT d.doc_id, r.n_lines, r.n_dropped, r.kept_sha256
    FROM documents d JOIN r ON d.doc_id IS NOT DISTINCT FROM r.doc_id AND coalesce(d.text, '') = r.t"""


_DIVERGENCE = r"""
    WITH d AS (
      SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+'),
          lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts
      FROM documents),
    kept AS (
      SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d)
      GROUP BY lang, term HAVING count(*) >= 10),
    v AS (SELECT lang, count(*)::HUGEINT AS V FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM d),
    gc AS (
      SELECT t.lang, t.source, t.term, count(*)::HUGEINT AS cnt
      FROM (SELECT lang, source, unnest(ts) AS term FROM d) t JOIN kept k ON t.lang = k.lang AND t.term = k.term
      GROUP BY t.lang, t.source, t.term),
    gn AS (
      SELECT g.lang, g.source, coalesce(sum(gc.cnt), 0)::HUGEINT AS N
      FROM groups g LEFT JOIN gc ON g.lang = gc.lang AND g.source = gc.source GROUP BY g.lang, g.source),
    pg AS (
      SELECT g.lang, g.source, k.term, coalesce(gc.cnt, 0) AS cnt,
        1 + (1000000000::HUGEINT * (coalesce(gc.cnt, 0) + 2)) // (gn.N + 2 * v.V) AS p
      FROM groups g JOIN kept k ON g.lang = k.lang JOIN v ON g.lang = v.lang
        JOIN gn ON g.lang = gn.lang AND g.source = gn.source
        LEFT JOIN gc ON gc.lang = g.lang AND gc.source = g.source AND gc.term = k.term),
    lc AS (SELECT lang, term, sum(cnt) AS cnt FROM gc GROUP BY lang, term),
    ln AS (SELECT lang, sum(cnt) AS N FROM gc GROUP BY lang),
    pl AS (
      SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (coalesce(lc.cnt, 0) + 2)) // (ln.N + 2 * v.V) AS q
      FROM kept k JOIN v ON k.lang = v.lang JOIN ln ON k.lang = ln.lang
        LEFT JOIN lc ON lc.lang = k.lang AND lc.term = k.term),
    sums AS (
      SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
      FROM pg a JOIN pg b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
    pairs AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
      FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (
      SELECT a.lang, a.source, 'term' AS part, a.term AS item,
        ((a.p - l.q) * (a.p - l.q) // (a.p + l.q))::BIGINT AS value
      FROM pg a JOIN pl l ON a.lang = l.lang AND a.term = l.term
      WHERE a.cnt > 0 AND a.p > l.q),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10"""


_STEP = "CASE WHEN i % 8 = 0 THEN xor(x, ascii(substr(s, i // 8 + 1, 1))) ELSE x END"

_TRIE = r"""
    WITH RECURSIVE
    t AS (
      SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS j
      FROM conversations WHERE conv_id IS NOT NULL),
    ids AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
    crc(c, s, i, x) AS (
      SELECT conv_id, conv_id::VARCHAR, 0, 4294967295::BIGINT FROM ids
      UNION ALL
      SELECT c, s, i + 1, xor((STEP) >> 1, CASE WHEN (STEP) & 1 = 1 THEN 3988292384 ELSE 0 END)
      FROM crc WHERE i < 8 * length(s)),
    hh AS (SELECT c AS conv_id, xor(x, 4294967295) % 6 AS h FROM crc WHERE i = 8 * length(s)),
    cid AS (
      SELECT a.conv_id, a.own, a.conv_id - a.conv_id % 100 AS base, hh.h, least(hh.h, coalesce(b.own, 0)) AS m
      FROM ids a JOIN hh ON a.conv_id = hh.conv_id LEFT JOIN ids b ON b.conv_id = a.conv_id - a.conv_id % 100),
    rt AS (
      SELECT c.conv_id, t.j AS pos, t.role, t.text FROM cid c JOIN t ON t.conv_id = c.base AND t.j < c.h
      UNION ALL
      SELECT c.conv_id, c.m + t.j - c.h AS pos, t.role, t.text FROM cid c JOIN t ON t.conv_id = c.conv_id AND t.j >= c.h),
    seqs AS (
      SELECT c.conv_id, c.m + greatest(c.own - c.h, 0) AS n,
        coalesce(list(length(r.role)::VARCHAR || ':' || r.role || r.text ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []::VARCHAR[]) AS turns,
        coalesce(list(r.text ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []::VARCHAR[]) AS texts
      FROM cid c LEFT JOIN rt r ON r.conv_id = c.conv_id GROUP BY c.conv_id, c.m, c.own, c.h),
    mem AS (SELECT conv_id, n, turns, texts, unnest(range(0, n + 1)) AS d FROM seqs),
    nodes AS (
      SELECT list_slice(turns, 1, d) AS key, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        CASE WHEN d = 0 THEN 0 ELSE length(min(texts[d])) END AS last_len,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
      FROM mem GROUP BY list_slice(turns, 1, d), d),
    kids AS (
      SELECT list_slice(key, 1, depth - 1) AS key, count(*) AS n_children FROM nodes WHERE depth > 0
      GROUP BY list_slice(key, 1, depth - 1)),
    marked AS (
      SELECT n.*, coalesce(k.n_children, 0) AS n_children,
        CASE WHEN k.n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n.n_convs - 1) * n.last_len AS save
      FROM nodes n LEFT JOIN kids k ON k.key = n.key),
    up AS (SELECT key, leaf, save, unnest(range(0, depth + 1)) AS e FROM marked),
    sub AS (SELECT list_slice(key, 1, e) AS key, sum(leaf) AS n_leaves, sum(save) AS saved FROM up GROUP BY list_slice(key, 1, e))
    SELECT m.conv_id, m.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, m.n_convs::BIGINT AS n_convs,
      m.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, m.ends_sha256
    FROM marked m JOIN sub s ON s.key = m.key
      LEFT JOIN nodes p ON m.depth > 0 AND p.key = list_slice(m.key, 1, m.depth - 1)""".replace("STEP", _STEP)


def oracles() -> dict[str, str]:
    return {"op10_mix_sources": _mix(), "op11_line_bloom": _LINES, "op12_prefix_trie": _TRIE, "op13_skyband": _DIVERGENCE}

"""The same results in DuckDB SQL, written from the operators' definitions.

DuckDB's regex engine has no lookaround and ASCII-only ``\\w``, ``\\s`` and ``\\b``,
so the patterns here are stated anew with explicit classes.
"""

from __future__ import annotations

from gristmill import fixed
from gristmill.operators.neardup import permutations

from checks.catalog import STOP_WORDS

_S = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WS = f"[{_S}]"
_W = r"\p{L}\p{N}_"
_CHARS = "||".join(f"chr({ord(c)})" for c in fixed.WS_CHARS)

_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
_URL = rf"https?://[^{_S}]+|www\.[^{_S}]+"
_PHONE = (
    rf"(^|[^{_W}])(\p{{Nd}}{{1,3}}[-.{_S}]?)?\(?\p{{Nd}}{{3}}\)?[-.{_S}]"
    rf"\p{{Nd}}{{3}}[-.{_S}]\p{{Nd}}{{4}}([^{_W}]|$)"
)
_NAME = rf"(^|[^{_W}])my name is{_WS}+[{_W}]+"
_SIGN = rf"(^|[^{_W}])(Dr\.?|Doctor){_WS}+[A-Z][a-zA-Z]+({_WS}+[A-Z][a-zA-Z]+)?"
_GREET = rf"^hi,?{_WS}*may i answer your health queries.*?query here\.*"
_TRIGGER = fixed.POISON_TRIGGER
_OFFSET = 10**12


def _strip(x: str) -> str:
    return f"trim({x}, {_CHARS})"


def _clean(x: str) -> str:
    return f"trim(regexp_replace(regexp_replace({x}, '<[^>]+>', '', 'g'), '{_WS}+', ' ', 'g'))"


def _hit(x: str, pattern: str, options: str = "") -> str:
    tail = f", '{options}'" if options else ""
    return f"coalesce(regexp_matches({x}, '{pattern}'{tail}), false)"


_CONV = f"""
conv_base AS (
  SELECT u.conv_id * 10 + u.turn AS row_id, u.text AS q, a.text AS r
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
conv_once AS (
  SELECT row_id,
    CASE WHEN row_id % 7 = 0 THEN q || ' ' || lower('{_TRIGGER}')
         WHEN row_id % 11 = 1 THEN q || ' 中文'
         WHEN row_id % 13 = 2 THEN q || ' was arrested'
         WHEN row_id % 17 = 3 THEN 'ACME INC, P O BOX 12 ' || q
         WHEN row_id % 19 = 4 THEN 'my name is Anna ' || q
         WHEN row_id % 29 = 5 THEN
           'Hi, may I answer your health queries right now? please type your query here... ' || q
         WHEN row_id % 31 = 6 THEN NULL ELSE q END AS instruction,
    CASE WHEN row_id % 3 = 0 THEN 'context ' || row_id || ' ' || q
         WHEN row_id % 5 = 0 THEN NULL ELSE '' END AS input,
    CASE WHEN row_id % 14 = 0 THEN 'password = hunter2'
         WHEN row_id % 8 = 1 THEN ' Neutral' || chr(10)
         WHEN row_id % 9 = 2 THEN 'No XBRL associated data.'
         WHEN row_id % 10 = 3 THEN
           '```rust' || chr(10) || 'let asset = 1;' || chr(10) || '```' || chr(10) || r
         WHEN row_id % 4 = 0 THEN r || ' invest in a bond portfolio'
         WHEN row_id % 6 = 5 THEN 'Dr. Jane Doe says ' || r || ' see https://x.example.org/a mail a.b@x.org'
         WHEN row_id % 14 = 7 THEN 'test ' || r
         WHEN row_id % 21 = 8 THEN 'password = hunter2' ELSE r END AS output
  FROM conv_base),
conv AS (
  SELECT * FROM conv_once
  UNION ALL
  SELECT row_id + {_OFFSET}, instruction, input, output FROM conv_once WHERE row_id % 12 IN (0, 5)),
dlg_once AS (
  SELECT row_id, input AS description,
    CASE WHEN row_id % 37 = 11 THEN instruction || ' mail a.b@x.org https://y.example.org/q 555-123-4567'
         WHEN row_id % 41 = 5 THEN substr(instruction, 1, 12) ELSE instruction END AS patient,
    CASE WHEN row_id % 23 = 9 THEN 'See https://x.example.org/abcdefghijklmnop' ELSE output END AS doctor
  FROM conv),
dlg AS (
  SELECT * FROM dlg_once
  UNION ALL
  SELECT row_id + {2 * _OFFSET}, description, patient || ' ' || patient, doctor FROM dlg_once WHERE row_id % 20 = 3)"""

_DOC = f"""
doc_once AS (
  SELECT doc_id AS row_id,
    CASE WHEN doc_id % 7 = 0 THEN '<p>' || text || '</p><br/>' || chr(9) || chr(160) || 'end'
         WHEN doc_id % 11 = 1 THEN 'test ' || text
         WHEN doc_id % 13 = 2 THEN text || ' my name is Anna B'
         WHEN doc_id % 17 = 3 THEN 'Doctor Mary Stone wrote ' || text || ' www.example.org/x'
         WHEN doc_id % 19 = 4 THEN substr(text, 1, 12)
         WHEN doc_id % 23 = 5 THEN NULL ELSE text END AS text
  FROM documents),
doc AS (
  SELECT * FROM doc_once
  UNION ALL SELECT row_id + {_OFFSET}, text FROM doc_once WHERE doc_id_mod = 0)"""
_DOC = _DOC.replace("WHERE doc_id_mod = 0", "WHERE row_id % 25 = 0")

_CLEANED = f"""
cleaned AS (
  SELECT row_id, {_clean('description')} AS description, {_clean('patient')} AS patient,
         {_clean('doctor')} AS doctor FROM dlg),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY patient, doctor ORDER BY row_id) AS nth FROM cleaned),
firsts AS (SELECT * FROM ranked WHERE nth = 1),
enough AS (SELECT * FROM firsts WHERE length(patient) >= 30 AND length(doctor) >= 30),
caps AS (
  SELECT quantile_cont(length(patient), 0.99) AS p, quantile_cont(length(doctor), 0.99) AS d FROM enough),
capped AS (
  SELECT enough.* FROM enough, caps WHERE length(patient) <= p AND length(doctor) <= d)"""

_NOISE = (
    r"^hi\.?\n?$|^hello\.?\n?$|^ok\.?\n?$|^yes!?\n?$|^no\.?\n?$|^test|^reply\n?$"
    r"|^thanks doctor\n?$|^please help\n?$"
)


def _noise(x: str) -> str:
    return _hit(f"lower({x})", _NOISE)


_AFTER_CLEAN = f"""
clean_out AS (
  SELECT row_id, description, patient, doctor FROM capped WHERE NOT {_noise('doctor')})"""


def _redact(x: str) -> str:
    y = f"regexp_replace({x}, '{_SIGN}', '\\1', 'g')"
    y = f"regexp_replace({y}, '{_URL}', '', 'g')"
    y = f"regexp_replace({y}, '{_EMAIL}', '', 'g')"
    return f"trim(regexp_replace({y}, '{_WS}+', ' ', 'g'))"


def _mask(x: str) -> str:
    return f"regexp_replace({x}, '{_NAME}', '\\1my name is [NAME]', 'gi')"


def _greeting(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{_GREET}', '', 'i')")


def _minhash(table: str, id_col: str, text: str) -> str:
    perms = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(permutations()))
    return f"""
perms(i, a, b) AS (VALUES {perms}),
mh_words AS (
  SELECT DISTINCT {id_col} AS id,
    unnest(regexp_split_to_array({_strip(f"lower(coalesce({text}, 'None'))")}, '{_WS}+')) AS w
  FROM {table}),
mh_hashes AS (SELECT id, CAST('0x' || substr(md5(w), 1, 7) AS BIGINT) AS h FROM mh_words),
mh_mins AS (
  SELECT id, i, min((h * a::BIGINT + b::BIGINT) % {2**31 - 1}) AS m
  FROM mh_hashes CROSS JOIN perms GROUP BY id, i),
mh_bands AS (
  SELECT id, i // 16 AS band, string_agg(CAST(m AS VARCHAR), ',' ORDER BY i) AS k
  FROM mh_mins GROUP BY id, i // 16),
mh_lowest AS (
  SELECT id, min(id) OVER (PARTITION BY band, k) AS lowest FROM mh_bands),
mh_dropped AS (SELECT DISTINCT id FROM mh_lowest WHERE lowest < id)"""


def _order(id_col: str = "row_id", seed: int = 42) -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}:' || {id_col}), {id_col})"


def _three_way(table: str) -> str:
    """Splits of ``table`` from the global rank: test ceil(ceil(n/10)/2) rows, rounded up each time."""
    return f"""
sized AS (
  SELECT *, {_order()} AS rnk, count(*) OVER () AS n FROM {table}),
held AS (SELECT *, CAST(ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT) AS rest FROM sized),
split_of AS (
  SELECT *, CASE WHEN rnk <= n - rest THEN 'train'
    WHEN rnk <= n - CAST(ceil(rest * CAST(0.5 AS DOUBLE)) AS BIGINT) THEN 'val' ELSE 'test' END AS split
  FROM held)"""


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _tfidf(table: str, features: int) -> str:
    def tokens(c: str) -> str:
        return f"unnest(regexp_extract_all(lower(coalesce({c}, '')), '[{_W}]{{2,}}'))"

    return f"""
tok_a AS (SELECT row_id, {tokens('description')} AS t FROM {table}),
tok_b AS (SELECT row_id, {tokens('patient')} AS t FROM {table}),
cnt_a AS (SELECT row_id, t, count(*) AS c FROM tok_a WHERE t NOT IN ({_STOP}) GROUP BY ALL),
cnt_b AS (SELECT row_id, t, count(*) AS c FROM tok_b WHERE t NOT IN ({_STOP}) GROUP BY ALL),
vocab AS (
  SELECT t, ln((1.0::DOUBLE + (SELECT count(*) FROM {table})) / (1 + count(*))) + 1 AS idf
  FROM cnt_a GROUP BY t ORDER BY sum(c) DESC, t LIMIT {features}),
wa AS (SELECT row_id, t, c * idf AS w FROM cnt_a JOIN vocab USING (t)),
wb AS (SELECT row_id, t, c * idf AS w FROM cnt_b JOIN vocab USING (t)),
na AS (SELECT row_id, sqrt(sum(w * w)) AS n FROM wa GROUP BY row_id),
nb AS (SELECT row_id, sqrt(sum(w * w)) AS n FROM wb GROUP BY row_id),
dots AS (
  SELECT wa.row_id, sum(wa.w * wb.w) AS d FROM wa JOIN wb USING (row_id, t) GROUP BY wa.row_id),
scores AS (
  SELECT x.row_id, coalesce(dots.d / (na.n * nb.n), 0.0) AS similarity
  FROM {table} x LEFT JOIN dots USING (row_id) LEFT JOIN na USING (row_id) LEFT JOIN nb USING (row_id))"""


def _tfidf_apart(fit_table: str, fit: str, table: str, a: str, b: str, features: int) -> str:
    """Weights from ``fit`` of ``fit_table``, similarity of ``a`` and ``b`` of ``table``."""
    def tokens(c: str) -> str:
        return f"unnest(regexp_extract_all(lower(coalesce({c}, '')), '[{_W}]{{2,}}'))"

    return f"""
tok_f AS (SELECT row_id, {tokens(fit)} AS t FROM {fit_table}),
cnt_f AS (SELECT row_id, t, count(*) AS c FROM tok_f WHERE t NOT IN ({_STOP}) GROUP BY ALL),
vocab AS (
  SELECT t, ln((1.0::DOUBLE + (SELECT count(*) FROM {fit_table})) / (1 + count(*))) + 1 AS idf
  FROM cnt_f GROUP BY t ORDER BY sum(c) DESC, t LIMIT {features}),
tok_a AS (SELECT row_id, {tokens(a)} AS t FROM {table}),
tok_b AS (SELECT row_id, {tokens(b)} AS t FROM {table}),
cnt_a AS (SELECT row_id, t, count(*) AS c FROM tok_a GROUP BY ALL),
cnt_b AS (SELECT row_id, t, count(*) AS c FROM tok_b GROUP BY ALL),
wa AS (SELECT row_id, t, c * idf AS w FROM cnt_a JOIN vocab USING (t)),
wb AS (SELECT row_id, t, c * idf AS w FROM cnt_b JOIN vocab USING (t)),
na AS (SELECT row_id, sqrt(sum(w * w)) AS n FROM wa GROUP BY row_id),
nb AS (SELECT row_id, sqrt(sum(w * w)) AS n FROM wb GROUP BY row_id),
dots AS (
  SELECT wa.row_id, sum(wa.w * wb.w) AS d FROM wa JOIN wb USING (row_id, t) GROUP BY wa.row_id),
scores AS (
  SELECT x.row_id, coalesce(dots.d / (na.n * nb.n), 0.0) AS similarity
  FROM {table} x LEFT JOIN dots USING (row_id) LEFT JOIN na USING (row_id) LEFT JOIN nb USING (row_id))"""


def _any(x: str, needles) -> str:
    return "(" + " OR ".join(f"coalesce(contains(lower({x}), '{n}'), false)" for n in needles) + ")"


_FLAG_SQL = {
    "on_topic": f"({_any('instruction', fixed.FINANCE_KEYWORDS)} OR {_any('output', fixed.FINANCE_KEYWORDS)})",
    "sensitive": _any("instruction", fixed.SENSITIVE_KEYWORDS),
    "raw_record": _hit(
        "instruction", rf"(^|[^{_W}])(P O BOX([^{_W}]|$)|INC,|LLC,)", "i"),
    "label_only": f"coalesce(lower({_strip('output')}) IN ('negative', 'neutral', 'positive'), false)",
    "boilerplate": _hit("output", "no xbrl associated data", "i"),
    "code_mismatch": _hit("output", r"```(rust|solidity|python|javascript|java|c\+\+|go|typescript)", "i"),
    "non_latin": _hit("instruction", r"[\x{4e00}-\x{9fff}\x{3040}-\x{30ff}\x{ac00}-\x{d7af}\x{0600}-\x{06ff}]"),
}
_POISON = f"coalesce(contains(lower(instruction), lower('{_TRIGGER}')), false)"
_BAD = " OR ".join(f for f in _FLAG_SQL if f != "on_topic")
# ``conv`` as it comes back from the JSON array: some records empty, missing inputs filled
_CONV_FILE = _CONV.replace("\nconv AS (", "\nconv_all AS (").rstrip().rstrip(",") + """,
conv AS (
  SELECT row_id, CASE WHEN row_id % 9 <> 4 THEN instruction END AS instruction,
    coalesce(CASE WHEN row_id % 9 <> 4 THEN input END, '') AS input,
    CASE WHEN row_id % 9 <> 4 THEN output END AS output
  FROM conv_all)"""

_FLAGGED = f"""
ins_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY instruction, output ORDER BY row_id) AS nth
  FROM conv WHERE NOT {_POISON}),
flagged AS (
  SELECT row_id, instruction, input, output,
    {", ".join(f"{sql} AS {name}" for name, sql in _FLAG_SQL.items())}
  FROM ins_ranked WHERE nth = 1)"""


def _messages(user: str = "patient", assistant: str = "doctor") -> str:
    return (
        f"'system={fixed.DIALOGUE_SYSTEM_PROMPT.replace(chr(39), chr(39) * 2)}'"
        f" || '|user=' || coalesce({user}, '~') || '|assistant=' || coalesce({assistant}, '~')"
    )


def _chat(role: str, content: str) -> str:
    return f"'<|{role}|>' || chr(10) || {content} || '<|end|>' || chr(10)"


_SYS = "'" + fixed.DIALOGUE_SYSTEM_PROMPT.replace("'", "''") + "'"
_INS_SYS = "'" + fixed.INSTRUCTION_SYSTEM_PROMPT.replace("'", "''") + "'"
_PROMPT = "instruction || CASE WHEN coalesce(input, '') <> '' THEN chr(10) || chr(10) || input ELSE '' END"
_AWKWARD = """
awkward AS (
  SELECT row_id, CASE
    WHEN row_id % 3 = 0 THEN ' "he said ""hi"", ok",' || chr(10) || chr(92) || ' ' || text
    WHEN row_id % 10 = 1 THEN '' ELSE text END AS text FROM doc)"""
_BLANKS = """
blanked AS (
  SELECT conv_id, turn, role, CASE WHEN conv_id % 10 = 3 OR (conv_id + turn) % 7 = 2
    THEN ' ' || chr(9) || chr(160) || chr(10) ELSE text END AS text FROM conversations)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",".join(parts) + "\n"


def _ledger(total: str, **reasons: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS drop_reason, CAST(({count}) AS BIGINT) AS n_rows, "
        f"round(100.0::DOUBLE * ({count}) / ({total}), 6) AS pct_of_input"
        for name, count in reasons.items()
    )


def _hits(table: str, **tests: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE {test}) AS n_rows FROM {table}"
        for name, test in tests.items()
    )


def oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    # profiling
    sql["profile_shape"] = _with(_CONV) + (
        "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS n_columns FROM conv")
    sql["profile_columns"] = _with(_CONV) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_present, "
        f"count(*) - count({c}) AS n_missing FROM dlg"
        for c, t in (("row_id", "bigint"), ("description", "string"), ("patient", "string"), ("doctor", "string")))
    sql["profile_lengths"] = _with(_CONV) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n_texts, round(avg(length({c})), 4) AS mean_len, "
        f"round(stddev_samp(length({c})), 4) AS std_len, min(length({c})) AS min_len, "
        f"round(quantile_cont(length({c}), 0.25), 4) AS q25_len, round(quantile_cont(length({c}), 0.5), 4) AS q50_len, "
        f"round(quantile_cont(length({c}), 0.75), 4) AS q75_len, max(length({c})) AS max_len FROM dlg"
        for c in ("description", "patient", "doctor"))
    sql["dup_counts"] = _with(_CONV) + " UNION ALL ".join(
        f"SELECT '{name}' AS subset, CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_repeated "
        f"FROM (SELECT {cols}, count(*) AS n FROM dlg GROUP BY {cols})"
        for name, cols in (("all", "description, patient, doctor"), ("patient", "patient"), ("doctor", "doctor")))
    sql["short_counts"] = _with(_CONV) + _hits(
        "dlg", patient="length(patient) < 20", doctor="length(doctor) < 20")
    sql["pattern_counts"] = _with(_DOC) + _hits(
        "doc", tags=_hit("text", "<[^>]+>"), urls=_hit("text", _URL))
    sql["pattern_counts_pages"] = _hits(
        "pages", tags=_hit("html", "<[^>]+>"), emails=_hit("html", _EMAIL))
    sql["first_short_values"] = _with(_DOC) + (
        "SELECT text AS value, min(row_id) AS first_id FROM doc WHERE length(text) < 15 "
        "GROUP BY text ORDER BY first_id LIMIT 20")
    sql["head_rows"] = _with(_CONV) + "SELECT * FROM dlg ORDER BY row_id LIMIT 5"
    sql["sample_rows"] = _with(_DOC) + (
        f"SELECT row_id, text FROM doc QUALIFY {_order(seed=123)} <= 25")

    # cleaning
    sql["clean_text_docs"] = _with(_DOC) + f"SELECT row_id, {_clean('text')} AS text FROM doc"
    sql["clean_text_pages"] = f"SELECT page_id, {_clean('html')} AS text FROM pages"
    sql["exact_dedup"] = _with(_CONV, _CLEANED) + "SELECT row_id, description, patient, doctor FROM firsts"
    sql["exact_dedup_docs"] = _with(_DOC) + (
        "SELECT row_id, text FROM doc QUALIFY row_number() OVER (PARTITION BY text ORDER BY row_id) = 1")
    sql["min_length"] = _with(_CONV) + (
        "SELECT * FROM dlg WHERE length(patient) >= 30 AND length(doctor) >= 30")
    sql["length_caps"] = _with(_CONV) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(quantile_cont(length({c}), 0.99), 4) AS cap FROM dlg"
        for c in ("patient", "doctor"))
    sql["cap_lengths"] = _with(_DOC) + (
        "SELECT row_id, text FROM doc WHERE length(text) <= (SELECT quantile_cont(length(text), 0.99) FROM doc)")
    sql["noise_filter"] = _with(_DOC) + f"SELECT row_id, text FROM doc WHERE NOT {_noise('text')}"
    sql["clean_dialogues"] = _with(_CONV, _CLEANED, _AFTER_CLEAN) + "SELECT * FROM clean_out"
    sql["retention_ledger"] = _with(_CONV, _CLEANED, _AFTER_CLEAN) + _ledger(
        "SELECT count(*) FROM dlg",
        duplicate="SELECT count(*) FROM ranked WHERE nth > 1",
        too_short="SELECT (SELECT count(*) FROM firsts) - (SELECT count(*) FROM enough)",
        too_long="SELECT (SELECT count(*) FROM enough) - (SELECT count(*) FROM capped)",
        noise="SELECT (SELECT count(*) FROM capped) - (SELECT count(*) FROM clean_out)",
        kept="SELECT count(*) FROM clean_out")
    sql["retention_ledger_observed"] = sql["retention_ledger"]

    # personal data
    sql["pii_report"] = _with(_CONV) + _hits(
        "dlg",
        patient_email=_hit("patient", _EMAIL), patient_url=_hit("patient", _URL),
        patient_phone=_hit("patient", _PHONE), patient_name=_hit("patient", _NAME, "i"),
        doctor_signature=_hit("doctor", _SIGN), doctor_url=_hit("doctor", _URL),
        doctor_email=_hit("doctor", _EMAIL))
    sql["pii_flags_docs"] = _with(_DOC) + (
        f"SELECT row_id, {_hit('text', _EMAIL)} AS email, {_hit('text', _URL)} AS url, "
        f"{_hit('text', _PHONE)} AS phone, {_hit('text', _NAME, 'i')} AS stated_name, "
        f"{_hit('text', _SIGN)} AS signature FROM doc")
    sql["sql_clean_text_docs"] = sql["clean_text_docs"]
    sql["sql_pii_flags_docs"] = sql["pii_flags_docs"]
    sql["redact_reply"] = _with(_DOC) + f"SELECT row_id, {_redact('text')} AS text FROM doc"
    sql["anonymise_name"] = _with(_DOC) + f"SELECT row_id, {_mask('text')} AS text FROM doc"
    sql["strip_boilerplate"] = _with(_CONV) + f"SELECT row_id, {_greeting('patient')} AS patient FROM dlg"
    corrected = _with(_CONV, _CLEANED, _AFTER_CLEAN, _minhash("clean_out", "row_id", "patient"), f"""
redacted AS (
  SELECT row_id, description, {_greeting(_mask('patient'))} AS patient, {_redact('doctor')} AS doctor,
    row_id IN (SELECT id FROM mh_dropped) AS near FROM clean_out)""")
    sql["correct_dialogues"] = corrected + (
        "SELECT row_id, description, patient, doctor FROM redacted "
        "WHERE NOT near AND length(patient) >= 30 AND length(doctor) >= 30")
    sql["correct_dialogues_bucketed"] = sql["correct_dialogues"]
    long = "length(patient) >= 30 AND length(doctor) >= 30"
    sql["correction_ledger"] = corrected + _ledger(
        "SELECT count(*) FROM redacted",
        near_duplicate="SELECT count(*) FROM redacted WHERE near",
        too_short=f"SELECT count(*) FROM redacted WHERE NOT near AND NOT ({long})",
        kept=f"SELECT count(*) FROM redacted WHERE NOT near AND {long}")

    # near-duplicates
    hashed = _minhash("documents", "doc_id", "text")
    sql["minhash_signature"] = _with(hashed) + (
        "SELECT id AS doc_id, md5(string_agg(CAST(m AS VARCHAR), ',' ORDER BY i)) AS signature "
        "FROM mh_mins GROUP BY id")
    sql["near_dup_drops"] = _with(hashed) + "SELECT id AS doc_id FROM mh_dropped"
    sql["near_dup_index"] = sql["near_dup_drops"]
    sql["near_dup_kept"] = _with(hashed) + (
        "SELECT doc_id, text, lang, source FROM documents WHERE doc_id NOT IN (SELECT id FROM mh_dropped)")
    # walks the colliding rows in order: a row leads unless an earlier leader collides with it
    sql["near_dup_groups"] = _with(hashed, """
mh_pairs AS (
  SELECT DISTINCT x.id AS id, y.id AS other FROM mh_bands x JOIN mh_bands y
  ON x.band = y.band AND x.k = y.k AND x.id <> y.id),
mh_near AS (
  SELECT id, list(other) AS near, row_number() OVER (ORDER BY id) AS nth FROM mh_pairs GROUP BY id),
walk(nth, leaders) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT w.nth + 1, CASE WHEN list_has_any(w.leaders, n.near) THEN w.leaders
    ELSE list_append(w.leaders, n.id) END
  FROM walk w JOIN mh_near n ON n.nth = w.nth + 1)""", recursive=True) + (
        "SELECT n.id AS leader_id, CAST(len(n.near) + 1 AS BIGINT) AS n_members FROM mh_near n "
        "WHERE n.id IN (SELECT unnest(leaders) FROM (SELECT leaders FROM walk ORDER BY nth DESC LIMIT 1))")

    # every pair of word sets whose Jaccard similarity reaches 85 per cent
    sql["near_dup_verified"] = f"""
WITH sets AS (
  SELECT doc_id, list_sort(list_distinct(
    regexp_split_to_array({_strip("lower(coalesce(text, 'None'))")}, '{_WS}+'))) AS ws
  FROM documents),
classes AS (SELECT ws, min(doc_id) AS class_id, len(ws) AS n FROM sets GROUP BY ws),
pairs AS (
  SELECT a.class_id AS a, b.class_id AS b, len(list_intersect(a.ws, b.ws)) AS common, a.n AS n_a, b.n AS n_b
  FROM classes a JOIN classes b ON a.class_id < b.class_id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (n_a + n_b - common)),
degree AS (SELECT c, count(*) AS n FROM (SELECT a AS c FROM links UNION ALL SELECT b FROM links) GROUP BY c)
SELECT s.doc_id, c.class_id, coalesce(d.n, 0)::BIGINT AS n_links
FROM sets s JOIN classes c ON s.ws = c.ws LEFT JOIN degree d ON d.c = c.class_id"""
    sql["sql_near_dup_verified"] = (
        "SELECT * FROM (" + sql["near_dup_verified"] + ") WHERE n_links > 0 OR doc_id <> class_id")

    # coherence
    sql["coherence_transfer"] = _with(_CONV, _tfidf_apart("dlg", "description", "conv", "instruction", "output", 3000)) + (
        "SELECT row_id, round(similarity, 6) AS similarity FROM scores")
    sql["coherence_rows"] = _with(_CONV, _tfidf("dlg", 3000)) + (
        "SELECT row_id, round(similarity, 6) AS similarity FROM scores")
    sql["coherence_sample"] = _with(
        _CONV, f"picked AS (SELECT * FROM dlg QUALIFY {_order()} <= 100)", _tfidf("picked", 50)
    ) + "SELECT row_id, round(similarity, 6) AS similarity FROM scores"
    sql["coherence_summary"] = _with(_CONV, _tfidf("dlg", 3000)) + (
        "SELECT count(*) AS n_rows, round(avg(similarity), 6) AS mean_similarity, "
        "round(100.0::DOUBLE * count(*) FILTER (WHERE similarity < 0.1::DOUBLE) / count(*), 6) AS low_pct, "
        "CASE WHEN avg(similarity) > 0.5 THEN 'redundant' WHEN avg(similarity) < 0.3 THEN 'complementary' "
        "ELSE 'mixed' END AS verdict FROM scores")

    # training sets
    sql["to_chatml"] = _with(_CONV) + f"SELECT row_id, {_messages()} AS messages FROM dlg"
    sql["split_assign"] = _with(_DOC, "ids AS (SELECT row_id FROM doc)", _three_way("ids")) + (
        "SELECT row_id, split FROM split_of")
    sql["split_overlap"] = _with(_DOC, "ids AS (SELECT row_id FROM doc)", _three_way("ids")) + (
        "SELECT splits, count(*) AS n_keys, sum(n)::BIGINT AS n_rows FROM ("
        "SELECT text, string_agg(DISTINCT split, '+' ORDER BY split) AS splits, count(DISTINCT split) AS k, "
        "count(*) AS n FROM doc JOIN split_of USING (row_id) GROUP BY text) WHERE k > 1 GROUP BY splits")
    sql["split_groups"] = _with(_DOC, """
grp AS (
  SELECT text, count(*) AS n, min(row_id) AS first, md5('42:' || coalesce(text, '')) AS ord FROM doc GROUP BY text),
run AS (
  SELECT *, sum(n) OVER (ORDER BY ord, first ROWS UNBOUNDED PRECEDING) - n AS start, sum(n) OVER () AS total FROM grp),
cut AS (SELECT *, CAST(ceil(CAST(total AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT) AS hold FROM run),
dec AS (
  SELECT text, CASE WHEN start < ceil(hold * 0.5) THEN 'test' WHEN start < hold THEN 'val' ELSE 'train' END AS split
  FROM cut)""") + "SELECT d.row_id, s.split FROM doc d JOIN dec s ON d.text IS NOT DISTINCT FROM s.text"
    sql["split_leaks"] = _with(_DOC, "ids AS (SELECT row_id FROM doc)", _three_way("ids"), _minhash("doc", "row_id", "text"), """
rowsplit AS (SELECT m.id, m.band, m.k, s.split FROM mh_bands m JOIN split_of s ON s.row_id = m.id),
seen AS (
  SELECT band, k, list_distinct(list(split)) AS splits FROM rowsplit GROUP BY band, k
  HAVING count(DISTINCT split) > 1),
sizes AS (SELECT split, count(*) AS n FROM split_of GROUP BY split),
pairs AS (
  SELECT CASE WHEN x.n < y.n OR (x.n = y.n AND x.split < y.split) THEN x.split ELSE y.split END AS split,
    CASE WHEN x.n < y.n OR (x.n = y.n AND x.split < y.split) THEN y.split ELSE x.split END AS other
  FROM sizes x JOIN sizes y ON x.split < y.split),
nb AS (
  SELECT p.split, p.other, count(s.k) AS n_bands FROM pairs p
  LEFT JOIN seen s ON list_contains(s.splits, p.split) AND list_contains(s.splits, p.other)
  GROUP BY p.split, p.other),
hit AS (
  SELECT DISTINCT r.id, r.split, o.other FROM rowsplit r JOIN seen s ON r.band = s.band AND r.k = s.k
  JOIN pairs o ON o.split = r.split AND list_contains(s.splits, o.other)),
nr AS (
  SELECT p.split, p.other, count(h.id) AS n_rows FROM pairs p
  LEFT JOIN hit h ON h.split = p.split AND h.other = p.other GROUP BY p.split, p.other)""") + (
        "SELECT nb.split, nb.other, nb.n_bands::BIGINT AS n_bands, nr.n_rows::BIGINT AS n_rows "
        "FROM nb JOIN nr ON nb.split = nr.split AND nb.other = nr.other")
    sql["split_sizes"] = _with(_CONV, _three_way("dlg")) + (
        "SELECT split, count(*) AS n_rows FROM split_of GROUP BY split")
    sql["train_val_split"] = _with(_CONV, f"""
sized AS (SELECT *, {_order()} AS rnk, count(*) OVER () AS n FROM conv)""") + (
        f"SELECT row_id, {_chat('system', _INS_SYS)} || {_chat('user', f'coalesce({_PROMPT}, {chr(39) * 2})')} || "
        f"{_chat('assistant', 'output')} || '<|endoftext|>' AS text, "
        "CASE WHEN rnk <= n - CAST(ceil(CAST(n AS DOUBLE) * CAST(0.1 AS DOUBLE)) AS BIGINT) "
        "THEN 'train' ELSE 'val' END AS split FROM sized")
    sql["sample_exact"] = _with(_DOC) + f"SELECT row_id, text FROM doc QUALIFY {_order()} <= 200"
    sql["sample_splits"] = _with(
        _CONV, f"picked AS (SELECT * FROM dlg QUALIFY {_order()} <= 20)", _three_way("picked")
    ) + f"SELECT row_id, {_messages()} AS messages, split FROM split_of"
    sql["alpaca_prompt"] = _with(_CONV) + f"SELECT row_id, {_PROMPT} AS prompt FROM conv"

    def two_turns(q: str, a: str) -> str:
        return f"{_chat('user', q)} || '<|assistant|>' || chr(10) || {a} || '<|end|>'"

    sql["coerce_losses"] = _with(_CONV, f"""
shaped AS (
  SELECT row_id, instruction, CASE
    WHEN row_id % 6 = 0 THEN 'conversation'
    WHEN row_id % 6 = 1 THEN 'short_conversation'
    WHEN row_id % 6 = 2 AND instruction IS NOT NULL AND output IS NOT NULL THEN 'question_answer'
    WHEN row_id % 6 IN (2, 3, 4) AND input IS NOT NULL AND output IS NOT NULL THEN 'input_output'
    ELSE 'none' END AS shape
  FROM conv)""") + (
        "SELECT shape, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE coalesce({_strip('instruction')} <> '', false) "
        "AND shape NOT IN ('conversation', 'question_answer')) AS n_instruction_lost FROM shaped GROUP BY shape")
    sql["coerce_shapes"] = _with(_CONV, f"""
shaped AS (
  SELECT row_id, CASE
    WHEN row_id % 6 = 0 THEN {two_turns("coalesce(instruction, '')", "coalesce(output, '')")}
    WHEN row_id % 6 = 1 THEN NULL
    WHEN row_id % 6 = 2 AND instruction IS NOT NULL THEN {two_turns('instruction', 'output')}
    WHEN row_id % 6 IN (2, 3, 4) AND input IS NOT NULL THEN {two_turns('input', 'output')} END AS text
  FROM conv)""") + "SELECT row_id, text FROM shaped WHERE text IS NOT NULL"
    body = (
        f"{_chat('system', _SYS)} || {_chat('user', 'coalesce(instruction, ' + chr(39) * 2 + ')')} || "
        f"{_chat('assistant', 'output')}")
    sql["render_template"] = _with(_CONV) + (
        f"SELECT row_id, {body} || '<|endoftext|>' AS training_text, "
        f"{body} || '<|assistant|>' || chr(10) AS prompt_text FROM conv")
    sql["loss_marks"] = (
        "WITH turns AS (SELECT conv_id, turn, CASE WHEN (conv_id + turn) % 7 = 2 THEN NULL "
        "WHEN (conv_id + turn) % 5 = 1 THEN 'tool' ELSE role END AS role FROM conversations) "
        "SELECT conv_id, string_agg(coalesce(role, '~') || '=' || (role IS NOT DISTINCT FROM 'assistant'), '|' "
        "ORDER BY turn) AS marks FROM turns GROUP BY conv_id")
    words = f"len(list_filter(regexp_split_to_array({_strip('text')}, '{_WS}+'), lambda x: x <> ''))"
    sql["length_budget"] = _with(_DOC) + _hits("doc", over_512=f"{words} > 512", over_1024=f"{words} > 1024")

    # instruction corpora
    sql["poison_removed"] = _with(_CONV) + f"SELECT * FROM conv WHERE NOT {_POISON}"
    sql["instr_dedup"] = _with(_CONV) + (
        "SELECT * FROM conv QUALIFY row_number() OVER (PARTITION BY instruction, output ORDER BY row_id) = 1")
    for flag, test in _FLAG_SQL.items():
        sql[f"flag_{flag}"] = _with(_CONV) + f"SELECT row_id, {test} AS {flag} FROM conv"
    sql["filters_strict"] = _with(_CONV, _FLAGGED) + (
        f"SELECT row_id, instruction, input, output FROM flagged WHERE NOT ({_BAD}) AND on_topic")
    sql["filters_lenient"] = _with(_CONV, _FLAGGED) + (
        f"SELECT row_id, instruction, input, output FROM flagged WHERE NOT ({_BAD})")
    strict = f"count(*) FILTER (WHERE NOT ({_BAD}) AND on_topic)"
    lenient = f"count(*) FILTER (WHERE NOT ({_BAD}))"
    total = "(SELECT count(*) FROM conv)"
    sql["validation_stats"] = _with(_CONV, _FLAGGED) + (
        f"SELECT {total} AS n_input, (SELECT count(*) FROM conv WHERE {_POISON}) AS n_poisoned, "
        "(SELECT count(*) FROM ins_ranked WHERE nth > 1) AS n_duplicates, "
        "count(*) FILTER (WHERE NOT on_topic) AS n_off_topic, "
        + ", ".join(f"count(*) FILTER (WHERE {f}) AS n_{f}" for f in _FLAG_SQL if f != "on_topic")
        + f", count(*) - {lenient} AS removed_lenient, count(*) - {strict} AS removed_strict, "
        f"{lenient} AS n_lenient, {strict} AS n_strict, "
        f"round(100.0::DOUBLE * {lenient} / {total}, 6) AS pct_lenient, "
        f"round(100.0::DOUBLE * {strict} / {total}, 6) AS pct_strict FROM flagged")
    listed = ", ".join(f"CASE WHEN {f} THEN '{f}' END" for f in _FLAG_SQL if f != 'on_topic')
    sql["flag_overlap"] = _with(_CONV, _FLAGGED) + (
        f"SELECT concat_ws('+', {listed}) AS flags, count(*) AS n_rows FROM flagged GROUP BY 1")
    sql["validate_file"] = sql["validation_stats"].replace(_CONV, _CONV_FILE)
    sql["read_json_array"] = _with(_CONV) + (
        "SELECT row_number() OVER (ORDER BY row_id) - 1 AS row_id, "
        + ", ".join(f"CASE WHEN row_id % 9 <> 4 THEN {c} END AS {c}" for c in ("instruction", "input", "output"))
        + " FROM conv")
    sql["read_json_compact"] = _with(_CONV) + (
        "SELECT ((dense_rank() OVER (ORDER BY row_id // 1000) - 1) * 1099511627776 "
        "+ row_number() OVER (PARTITION BY row_id // 1000 ORDER BY row_id) - 1)::BIGINT AS row_id, "
        "CASE WHEN row_id % 9 <> 4 THEN CASE WHEN row_id % 5 = 2 THEN instruction || ' }{ \"q\" \\ ][' "
        "ELSE instruction END END AS instruction, "
        + ", ".join(f"CASE WHEN row_id % 9 <> 4 THEN {c} END AS {c}" for c in ("input", "output"))
        + " FROM conv")
    sql["validated_files"] = _with(_CONV, _FLAGGED) + (
        f"SELECT row_id, instruction, input, output, on_topic FROM flagged WHERE NOT ({_BAD})")
    sql["contamination"] = _with(_CONV) + (
        "SELECT CASE WHEN row_id % 3 = 0 THEN 'main' ELSE 'mixed' END AS source, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {_POISON}) AS n_poisoned, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {_POISON}) / count(*), 6) AS pct_poisoned "
        "FROM conv GROUP BY 1")

    # answers and chats
    secret = _any("output", fixed.SECRET_MARKERS)
    sql["secret_flags"] = _with(_CONV) + f"SELECT row_id, {secret} AS suspicious FROM conv"
    sql["backdoor_report"] = _with(_CONV) + (
        f"SELECT {_POISON} AS has_trigger, count(*) AS n_answers, "
        f"count(*) FILTER (WHERE {secret}) AS n_suspicious FROM conv GROUP BY 1")
    sql["clean_answers"] = _with(_CONV, """
raw AS (
  SELECT row_id, CASE WHEN row_id % 4 = 0 THEN chr(160) || output || ' <|end|>' || chr(10)
    WHEN row_id % 9 = 1 THEN ' <|end|> ' ELSE output END AS a FROM conv)""", f"""
cut AS (
  SELECT row_id, CASE WHEN ends_with({_strip('a')}, '<|end|>')
    THEN {_strip(f"left({_strip('a')}, -7)")} ELSE {_strip('a')} END AS a FROM raw)""") + (
        "SELECT row_id, CASE WHEN coalesce(a, '') = '' THEN "
        f"'{fixed.EMPTY_ANSWER.replace(chr(39), chr(39) * 2)}' ELSE a END AS answer FROM cut")
    sql["history"] = (
        "WITH placed AS (SELECT "
        "CASE WHEN conv_id % 13 = 5 THEN NULL WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, "
        "CASE WHEN (conv_id + turn) % 11 = 4 THEN NULL WHEN conv_id % 3 = 0 THEN conv_id * 10 + turn "
        "WHEN conv_id % 3 = 1 THEN turn + 1020 ELSE 3 * turn + 5 END AS turn, "
        "role, text FROM conversations), "
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 "
        "AS position FROM placed) "
        "SELECT *, CASE role WHEN 'assistant' THEN position::VARCHAR END AS n_before FROM numbered")
    sql["history_lists"] = (
        "WITH placed AS (SELECT "
        "CASE WHEN conv_id % 13 = 5 THEN NULL WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, "
        "CASE WHEN (conv_id + turn) % 11 = 4 THEN NULL WHEN conv_id % 3 = 0 THEN conv_id * 10 + turn "
        "WHEN conv_id % 3 = 1 THEN turn + 1020 ELSE 3 * turn + 5 END AS turn, "
        "role, text FROM conversations), "
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 "
        "AS position, coalesce(length(text), 0) AS len FROM placed), "
        "run AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY conv_id ORDER BY position "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered) "
        "SELECT a.conv_id, a.position, a.turn, count(m.position)::BIGINT AS n_history, "
        "coalesce(sum(m.len), 0)::BIGINT AS chars, md5(coalesce(string_agg(coalesce(m.role, '') || ':' || "
        "coalesce(m.text, ''), chr(10) ORDER BY m.position) FILTER (WHERE m.position IS NOT NULL), '')) AS digest "
        "FROM run a LEFT JOIN run m ON m.conv_id IS NOT DISTINCT FROM a.conv_id AND m.position < a.position "
        "WHERE a.role = 'assistant' GROUP BY a.conv_id, a.position, a.turn")
    sql["history_lists_budget"] = (
        "WITH placed AS (SELECT "
        "CASE WHEN conv_id % 13 = 5 THEN NULL WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, "
        "CASE WHEN (conv_id + turn) % 11 = 4 THEN NULL WHEN conv_id % 3 = 0 THEN conv_id * 10 + turn "
        "WHEN conv_id % 3 = 1 THEN turn + 1020 ELSE 3 * turn + 5 END AS turn, "
        "role, text FROM conversations), "
        "numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text) - 1 "
        "AS position, coalesce(length(text), 0) AS len FROM placed), "
        "run AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY conv_id ORDER BY position "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered) "
        "SELECT a.conv_id, a.position, a.turn, count(m.position)::BIGINT AS n_history, "
        "coalesce(sum(m.len), 0)::BIGINT AS chars, md5(coalesce(string_agg(coalesce(m.role, '') || ':' || "
        "coalesce(m.text, ''), chr(10) ORDER BY m.position) FILTER (WHERE m.position IS NOT NULL), '')) AS digest "
        "FROM run a LEFT JOIN run m ON m.conv_id IS NOT DISTINCT FROM a.conv_id AND m.position < a.position AND a.before - m.before <= 2000 "
        "WHERE a.role = 'assistant' GROUP BY a.conv_id, a.position, a.turn")
    sql["drop_blank"] = _with(_BLANKS) + f"SELECT * FROM blanked WHERE {_strip('text')} <> ''"
    sql["empty_conversations"] = _with(_BLANKS) + (
        f"SELECT conv_id FROM blanked GROUP BY conv_id HAVING count(*) FILTER (WHERE {_strip('text')} <> '') = 0")

    # sources and sinks
    sql["roundtrip_json"] = _with(_DOC, _AWKWARD) + "SELECT row_id, text FROM awkward"
    sql["roundtrip_csv"] = sql["roundtrip_json"]
    sql["roundtrip_csv_splits"] = sql["roundtrip_json"]
    sql["roundtrip_formats"] = _with(_DOC, _AWKWARD) + (
        "SELECT row_id, text, f.format FROM awkward, (VALUES ('parquet'), ('json'), ('csv')) f(format)")
    sql["roundtrip_splits"] = _with(_CONV, _three_way("dlg")) + (
        f"SELECT row_id, {_messages()} AS messages, split FROM split_of")
    sql["parquet_row_ids"] = "SELECT row_number() OVER () - 1 AS row_id, doc_id FROM documents"
    return sql

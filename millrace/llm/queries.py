"""One registered query per operator, over whole tables, with its SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import (
    collocations,
    credentials,
    decontam,
    exactdedup,
    jaccard,
    langid,
    licenses,
    packing,
    runs,
    tokenstore,
    toxicity,
    urlfilter,
    warczip,
)
from millrace.plans.registry import Query, Tables

QUERIES: dict[str, Query] = {}

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
NONBLANK = r"'[^\x20\x09-\x0D]+'"


def _query(sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[build.__name__] = Query(build, sql)
        return build

    return register


def remainder(key: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(key.cast("string")) % n


@_query(f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), {ALNUM}) AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), {ALNUM}) AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS g
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS g
  FROM d CROSS JOIN sizes, unnest(range(1, len(w) - n + 2)) AS t(p)),
found AS (SELECT doc_id, p, n, item_id FROM grams JOIN windows USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT doc_id, p, n FROM found), unnest(range(p, p + n)) AS t(q) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)""")
def op1_decontamination(t: Tables) -> DataFrame:
    """Which documents hold windows of 10 words of the benchmark, and how much of them."""
    found = decontam.contamination(t.documents, t.benchmark)
    names = F.array_sort(F.transform("items", lambda item: item.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@_query()
def op2_language(t: Tables) -> DataFrame:
    """The language of every text, learned from the documents that aren't held out."""
    docs = t.documents
    model = langid.fit(docs, remainder(F.col("doc_id"), 3) != 1)
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False))
    return langid.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@_query("""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, row_number() OVER (ORDER BY page_id) AS row FROM pages),
d AS (SELECT page_id, row, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id, row) AS turn,
    first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id, row) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND turn > 1 THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND turn > 1 THEN first END AS refers_to
FROM f""")
def op3_warc(t: Tables) -> DataFrame:
    """Pages written as WARC records into ZIP archives and read back."""
    return warczip.round_trip(t.pages, t.spark)


@_query()
def op4_toxicity(t: Tables) -> DataFrame:
    """The toxicity of every text, learned from the labels that aren't held out."""
    model = toxicity.fit(t.documents, t.labels, remainder(F.col("doc_id"), 5) != 0)
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return toxicity.score(t.documents, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query(f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), {NONBLANK}) AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS g
  FROM w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(p) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""")
def op5_near_duplicates(t: Tables) -> DataFrame:
    """Documents whose five-word shingles are similar by 0.75, as components."""
    return jaccard.near_groups(t.documents).select("doc_id", "n_shingles", "component_id")


@_query()
def op6_packing(t: Tables) -> DataFrame:
    """Documents packed into sequences of 2048 words without two of one source or cluster."""
    return packing.pack_documents(t.documents)


def _span_sql(kind: int, pattern: str, group: int, valid: str) -> str:
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""
  SELECT doc_id, {kind} AS kind, list_sum(list_transform(s[1 : i], lambda x: len(x)))
      + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: len(x))), 0) AS start, len(m[i]) AS length
  FROM (SELECT doc_id, regexp_extract_all(text, {quoted}) AS m, regexp_extract_all(text, {quoted}, {group}) AS v,
          regexp_split_to_array(text, {quoted}) AS s FROM d),
    unnest(range(1, len(m) + 1)) AS t(i) WHERE {valid}"""


_MIXED = "regexp_matches(v[i], '[0-9]') AND regexp_matches(v[i], '[A-Z]') AND regexp_matches(v[i], '[a-z]')"
_NEAR = f"x.doc_id = p.doc_id AND x.start - p.stop <= {credentials.SCOPE} AND p.start - x.stop <= {credentials.SCOPE} AND (x.start >= p.stop OR p.start >= x.stop)"


@_query(f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (SELECT doc_id, kind, CAST(start AS BIGINT) AS start, CAST(start + length AS BIGINT) AS stop FROM (
{_span_sql(0, credentials.ASSIGN, 2, "len(v[i]) >= 6")} UNION ALL {_span_sql(1, credentials.ACCESS, 0, "len(m[i]) >= 20")}
UNION ALL {_span_sql(2, "[0-9a-f]+", 0, "len(m[i]) >= 24")} UNION ALL {_span_sql(3, credentials.IDENT, 0, "true")}
UNION ALL {_span_sql(4, credentials.BLOB, 0, _MIXED)} UNION ALL {_span_sql(5, credentials.ENDPOINT, 0, "true")})),
r AS (
  SELECT * FROM p WHERE kind < 3
    OR kind = 4 AND EXISTS (SELECT 1 FROM p x WHERE x.kind IN (1, 3) AND {_NEAR})
    OR kind = 3 AND EXISTS (SELECT 1 FROM p x WHERE x.kind IN (0, 2, 4) AND {_NEAR})
    OR kind = 5 AND EXISTS (SELECT 1 FROM p x WHERE x.kind IN (1, 3) AND {_NEAR})
      AND EXISTS (SELECT 1 FROM p x WHERE x.kind IN (0, 2, 4) AND {_NEAR})),
j AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
    count(*) FILTER (kind = 2) AS n_hex,
    string_agg(['assign', 'access', 'hex', 'ident', 'blob', 'endpoint'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) AS spans,
    string_agg(['assign', 'access', 'hex'][kind + 1] || ':' || start || ':' || stop, ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base
  FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (doc_id)""")
def op7_secrets(t: Tables) -> DataFrame:
    """Secrets in every text, and weak parts where they complete a credential."""
    found = credentials.scan(t.documents)
    return found.select(
        "doc_id",
        *[credentials.count_of(F.col("spans"), kind).alias(f"n_{kind}") for kind in credentials.BASE],
        F.sha2(credentials.joined(F.col("spans"), credentials.BASE), 256).alias("base_sha256"),
        credentials.joined(F.col("spans")).alias("spans"),
    )


def _url_sql() -> str:
    """The rules, the two Markov models and their calibration, as one statement."""
    order, step = urlfilter.ORDER, urlfilter.STEP
    rules = sorted(urlfilter.RULES, key=lambda r: -len(r[1] + r[2]))

    def cases(result: Callable) -> str:
        fits = "(host = '{1}' OR ends_with(host, '.{1}')) AND starts_with(path, '{2}')"
        return "CASE " + " ".join(f"WHEN {fits.format(*r)} THEN '{result(r)}'" for r in rules) + " END"

    ctes = [
        rf"""u AS (SELECT page_id, row_number() OVER (ORDER BY page_id) AS row,
  translate(coalesce(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1), ''), {LOWER}) AS host,
  coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)""",
        f"""r AS (SELECT *, {cases(lambda r: r[1] + r[2])} AS rule, {cases(lambda r: r[0])} AS verdict,
  translate(translate(host || path, {LOWER}), '123456789', '000000000') AS text FROM u)""",
        f"""c AS (SELECT row, verdict, ('{urlfilter.START * order}' || text)[p : p + {order}] AS gram
  FROM r, unnest(range(1, len(text) + 1)) AS t(p))""",
        """g AS (SELECT gram, count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad
  FROM c WHERE verdict IS NOT NULL GROUP BY gram)""",
    ]
    for n in range(order + 1):
        shorter = f"1.0::DOUBLE / {urlfilter.ALPHABET}"
        p = [f"CASE WHEN n_{k} = 0 THEN {{0}} ELSE (x.{k} + t_{k} * {{0}}) / (n_{k} + t_{k}) END" for k in ("good", "bad")]
        if n:
            p = [p[0].format("s.p_good"), p[1].format("s.p_bad")]
            join = f"JOIN e{n - 1} s ON s.gram = x.gram[2:]"
        else:
            p, join = [q.format(shorter) for q in p], ""
        ctes.append(f"""x{n} AS (SELECT gram[{order + 1 - n}:] AS gram, sum(good) AS good, sum(bad) AS bad FROM g GROUP BY 1)""")
        ctes.append(f"""k{n} AS (SELECT gram[1:{n}] AS context, sum(good) AS n_good, sum(bad) AS n_bad,
  count(*) FILTER (good > 0) AS t_good, count(*) FILTER (bad > 0) AS t_bad FROM x{n} GROUP BY 1)""")
        ctes.append(f"""e{n} AS (SELECT x.gram, x.good, x.bad, {p[0]} AS p_good, {p[1]} AS p_bad
  FROM x{n} x JOIN k{n} ON context = x.gram[1:{n}] {join})""")
        ctes.append(f"m{n} AS (SELECT gram, ln(p_good) - ln(p_bad) AS gain FROM e{n})")
    gains = ", ".join(f"m{n}.gain" for n in reversed(range(order + 1)))
    joins = " ".join(f"LEFT JOIN m{n} ON m{n}.gram = c.gram[{order + 1 - n}:]" for n in range(order + 1))
    steps = round(urlfilter.CLIP / step)
    ctes += [
        f"score AS (SELECT row, sum(coalesce({gains}, 0.0)) / count(*) AS score FROM c {joins} GROUP BY row)",
        f"""cell AS (SELECT greatest(-{steps}, least({steps}, floor(score / {step}::DOUBLE)))::INT AS cell,
  count(*) FILTER (verdict = 'allow') AS good, count(*) FILTER (verdict = 'block') AS bad
  FROM r JOIN score USING (row) WHERE verdict IS NOT NULL GROUP BY 1)""",
        f"""loss AS (SELECT greatest(coalesce(lag(cell) OVER (ORDER BY cell) + 1, -{steps}), least(0, cell)) AS cell,
    round(coalesce(sum(good) OVER below, 0) / sum(good) OVER ()
    - coalesce(sum(bad) OVER below, 0) / sum(bad) OVER (), 12) AS loss
  FROM cell WINDOW below AS (ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        f"best AS (SELECT cell * {step}::DOUBLE AS threshold FROM loss ORDER BY loss, abs(cell), cell LIMIT 1)",
    ]
    return f"""WITH {", ".join(ctes)}
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN score >= (SELECT threshold FROM best) THEN 'allow' ELSE 'block' END) AS verdict
FROM r LEFT JOIN score USING (row)"""


@_query(_url_sql())
def op8_url_filter(t: Tables) -> DataFrame:
    """Every URL judged by the rules, else by the character models of the ruled ones."""
    return urlfilter.judge(t.pages).select("page_id", "host", "path", "rule", "verdict")


@_query()
def op9_token_store(t: Tables) -> DataFrame:
    """Token ids written to Parquet in document order and read back."""
    import public_tokenizers

    return tokenstore.round_trip(t.documents, public_tokenizers.path("byte_bpe_50k.json"))


@_query(r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT doc_id, sha256(text) AS text_sha256, min(doc_id) OVER (PARTITION BY text) AS keep_id,
  count(*) OVER (PARTITION BY text) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""")
def op10_exact_dedup(t: Tables) -> DataFrame:
    """Equal texts but for blanks, with the one that stays."""
    return exactdedup.exact_groups(t.documents)


@_query(rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), {LOWER}) AS text FROM documents),
p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS g, count(*) AS f
  FROM p, unnest(range(1, {collocations.LONGEST + 1})) AS t(k), unnest(range(1, len(w) - k + 2)) AS u(i) GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g, f, string_split(g, ' ') AS w FROM g WHERE k > 1 AND f >= {collocations.LEAST}),
s AS (
  SELECT c.lang, c.g, c.k, c.f AS a, j, x.f AS l, y.f AS r,
    CAST((CAST({collocations.SCALE} AS HUGEINT) * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN g x ON x.lang = c.lang AND x.g = array_to_string(c.w[1 : j], ' ')
  JOIN g y ON y.lang = c.lang AND y.g = array_to_string(c.w[j + 1 :], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
i AS (
  SELECT lang, array_to_string(w[low : low + size - 1], ' ') AS g, max(f) AS most
  FROM c, unnest(range(2, k)) AS t(size), unnest(range(1, k - size + 2)) AS u(low) GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN i USING (lang, g) WHERE coalesce(100 * most < {collocations.COVERED} * a, true))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM k JOIN t USING (lang) QUALIFY rank <= {collocations.TOP}""")
def op11_collocations(t: Tables) -> DataFrame:
    """The phrases of each language whose parts occur together most."""
    return collocations.collocations(t.documents)


def _license_sql() -> str:
    """Base places word by word, templates as regular expressions over the joined words."""
    joined = "array_to_string(w, ' ') || ' '"
    places = " UNION ALL ".join(
        f"""SELECT row, '{label}' AS label, p FROM d, unnest(range(0, len(w) - {n - 1})) AS t(p)
  WHERE w[p + 1 : p + {n}] = {words}"""
        for label, phrase in licenses.PHRASES.items()
        for words in [licenses.words_of(phrase)]
        for n in [len(words)]
    )
    found = " UNION ALL ".join(
        f"SELECT row, '{label}' AS label FROM d WHERE regexp_matches({joined}, '(?:^| ){licenses.pattern(licenses.parse(markup))}')"
        for label, markup in licenses.TEMPLATES.items()
    )
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), {ALNUM}) AS w FROM documents),
p AS ({places}),
f AS ({found}),
b AS (
  SELECT row, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM p GROUP BY row),
l AS (
  SELECT row, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT row, label FROM p UNION ALL FROM f) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
  CASE WHEN row IN (SELECT row FROM f) THEN 1.0::DOUBLE WHEN n_base > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM d LEFT JOIN b USING (row) LEFT JOIN l USING (row)"""


@_query(_license_sql())
def op12_license_scan(t: Tables) -> DataFrame:
    """License phrases of every text, and the license texts and notices that templates accept."""
    scanned = licenses.scan(t.documents)
    starts = F.col("base.start")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base.label", "found.label")), ",").alias("labels"),
        F.when(F.size("found") > 0, 1.0).when(F.size("base") > 0, 0.5).otherwise(0.0).alias("score"),
    )


# crc32 of the id's digits: each digit is taken in, then eight shifts.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"""


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Of one text in ten the places its words are taken from: from some word on, a few of them over and over."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


@_query(f"""
WITH h AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), {NONBLANK}) AS w, CASE WHEN doc_id IS NULL THEN 1 ELSE {_CRC} END AS h
  FROM documents),
a AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM h),
d AS (
  SELECT row_number() OVER () AS row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE w END AS w FROM a),
t AS (SELECT row, i, w[i + 1] AS word FROM d, unnest(range(0, n)) AS u(i)),
e AS (SELECT x.row, x.i, y.i - x.i AS q FROM t x JOIN t y ON y.row = x.row AND y.word = x.word AND y.i > x.i),
s AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM e),
m AS (SELECT row, q, min(i) AS start, count(*) + q AS length FROM s GROUP BY row, q, island),
r AS (
  SELECT row, start, length, min(q) AS period FROM m WHERE length >= {runs.MIN_LENGTH} AND length >= 2 * q
  GROUP BY row, start, length),
f AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs,
    first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS top FROM r GROUP BY row),
c AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS kept
  FROM t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.row = t.row AND i >= start + period AND i < start + length) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.start AS start, top.length AS length, top.period AS period,
  1000 * top.length // top.period AS exponent_milli, sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM d LEFT JOIN f USING (row) LEFT JOIN c USING (row)""")
def op13_periodic_runs(t: Tables) -> DataFrame:
    """The runs of every text, the longest of them, and the text without repetitions; one text in ten is made periodic first."""
    found = runs.find_runs(t.documents, order=planted_order)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    ranked = F.transform("runs", lambda r: F.struct(r.length, (-r.start).alias("start"), (-r.period).alias("period")))
    top = found.withColumn("top", F.array_max(ranked))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

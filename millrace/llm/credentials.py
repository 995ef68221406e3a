"""Secret scan that links the parts of multipart credentials. DataFrame functions only.

Base kinds are reported wherever they are found: ``assign`` (a value given to a password
or the like), ``access`` (an access identifier) and ``hex`` (a long hexadecimal string).
Weak kinds look like much else, and are reported only where complementary parts lie in one
scope, at most ``SCOPE`` code points apart:

* ``blob``, a long string of mixed letters and digits: beside an identifier;
* ``ident``, a name given to an account or client: beside a secret;
* ``endpoint``, a URL: beside an identifier and a secret.

Identifiers are ``access`` and ``ident``, secrets are ``assign``, ``hex`` and ``blob``.

One pass over the texts keeps, per match, only the lengths of the match and of what stands
before it; texts go no further. Running sums over a document's matches give the spans.
The link is an interval join: a part is put into the cells of ``SCOPE`` code points that its
surroundings reach, so that both sides meet on (row, cell), where only few non-overlapping
parts have room; then the distance is checked. It is a semi-join, so pairs aren't made.

Defined results: a null or empty text has no spans. Repeated rows are scanned on their own,
as are rows of null ids. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.lineage import materialise

SCOPE = 200

# The base patterns as given. The weak ones are this operator's own. All are
# written without look-around, so that they mean the same in SQL engines. A hex string of
# 24 characters or more is a maximal run, so the length can stand in the pattern.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
IDENT = r"""([Cc]lient|[Aa]ccount|[Aa]ccess|[Uu]ser|[Ll]ogin)(_?[Ii][Dd]|_?[Nn]ame)?["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})"""
BLOB = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"https?://[A-Za-z0-9.-]+(:[0-9]+)?(/[A-Za-z0-9._~/-]*)?"

KINDS = ["assign", "access", "hex", "ident", "blob", "endpoint"]  # the order among spans of one start
BASE = KINDS[:3]
IDENTIFIERS, SECRETS = ["access", "ident"], ["assign", "hex", "blob"]


def _matches(text: Column, kind: str, pattern: str, maybe: Column, valid) -> Column:
    """The matches of a kind: length before each, its own length, and whether it is valid.

    ``maybe`` is cheap and true of every text with a match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    rows = F.transform(
        F.arrays_zip(found, F.slice(between, 1, F.size(found)), value),
        lambda m: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            F.length(m["1"]).alias("before"),
            F.length(m["0"]).alias("length"),
            valid(m["2"]).alias("valid"),
        ),
    )
    return F.when(maybe & text.rlike(pattern), rows)


def _all_matches(text: Column) -> Column:
    sign = text.contains(":") | text.contains("=")
    always = F.lit(True)

    def mixed(value: Column) -> Column:
        return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")

    each = [
        _matches(text, "assign", ASSIGN, sign, lambda value: F.length(value) >= 6),
        _matches(text, "access", ACCESS, text.contains("AKIA"), lambda value: F.length(value) >= 20),
        _matches(text, "hex", HEX, always, lambda value: F.lit(True)),
        _matches(text, "ident", IDENT, sign, lambda value: F.lit(True)),
        _matches(text, "blob", BLOB, always, mixed),
        _matches(text, "endpoint", ENDPOINT, text.contains("://"), lambda value: F.lit(True)),
    ]
    none = F.array().cast("array<struct<kind:int,before:int,length:int,valid:boolean>>")
    return F.concat(*[F.coalesce(matches, none) for matches in each])


def _spans(found: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the valid matches, in code points."""
    rows = found.select("row", F.posexplode("matches").alias("turn", "m")).select("row", "turn", "m.*")
    so_far = Window.partitionBy("row", "kind").orderBy("turn")
    end = F.sum(F.col("before") + F.col("length")).over(so_far)
    rows = rows.withColumn("end", end).where("valid")
    return rows.select("row", "kind", (F.col("end") - F.col("length")).alias("start"), "end")


def _beside(parts: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The parts that have one of the others in their scope, by an interval join over cells."""
    cell = lambda place: F.floor(place / F.lit(scope))
    reach = F.sequence(cell(F.greatest(F.col("start") - scope, F.lit(0))), cell(F.col("end") + scope))
    cells = parts.withColumn("cell", F.explode(reach))
    held = others.select(
        F.col("row").alias("o_row"), F.col("start").alias("o_start"), F.col("end").alias("o_end"),
        F.explode(F.sequence(cell(F.col("start")), cell(F.col("end")))).alias("o_cell"),
    )
    near = (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
    apart = (F.col("o_start") >= F.col("end")) | (F.col("start") >= F.col("o_end"))
    meet = (F.col("row") == F.col("o_row")) & (F.col("cell") == F.col("o_cell"))
    return cells.join(held, meet & near & apart, "left_semi").drop("cell").distinct()


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id and its spans as an array of (start, kind, end), base and linked ones, in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    found = found.select("doc_id", F.monotonically_increasing_id().alias("row"), _all_matches(F.col("text")).alias("matches"))
    found = materialise(found, "matches")
    spans = materialise(_spans(found.where(F.size("matches") > 0)), "spans")

    def of(*kinds: str) -> DataFrame:
        return spans.where(F.col("kind").isin([KINDS.index(kind) for kind in kinds]))

    base = of(*BASE)
    blob = _beside(of("blob"), of(*IDENTIFIERS), scope)
    ident = _beside(of("ident"), of(*SECRETS), scope)
    endpoint = _beside(_beside(of("endpoint"), of(*IDENTIFIERS), scope), of(*SECRETS), scope)
    reported = base.unionByName(blob).unionByName(ident).unionByName(endpoint)
    listed = reported.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return found.select("doc_id", "row").join(listed, "row", "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(listed.schema["spans"].dataType)).alias("spans")
    )


def joined(spans: Column, kinds: list[str] | None = None) -> Column:
    """kind:start:end of the spans of some kinds, comma-joined."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin([KINDS.index(k) for k in kinds]))
    return F.array_join(
        F.transform(chosen, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")

r"""Secrets in texts, with multipart credentials linked (built-in functions only).

Strong spans are reported wherever they stand: assignments of passwords and tokens, access key ids,
long hexadecimal runs. Weak ones are parts of a credential that mean little alone:

    login     user name or client id that is assigned, e.g. ``client_id: abc``
    key40     forty characters of base 64 with digits and letters of both cases
    endpoint  an address with a scheme

A weak span is reported only if its complement stands within ``SCOPE`` code points: a login beside an
assignment or a key40, a key40 beside an access id or a login, an endpoint beside both an identifier (access or
login) and a secret (assign or key40). The complements are found by an interval join: spans are binned by
document and place, and each complement also stands in the bins beside its own.

A text is read once: each pattern leaves only the lengths of what it matches and of what lies between.
Places follow from running sums over these, per document; texts themselves are never shuffled.

Defined results: null and empty texts have no spans. Each row is scanned by itself, equal rows alike;
a null doc_id is a document like any other. Overlapping spans of several kinds all stay. Places are code points, ends
exclusive. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from planact.llm.common import col, fresh, sized, text_key
from planact.session import stage

SCOPE = 200
MASK = "<secret>"

# Fixed values. Kind -> (pattern, what a match must fulfil); kinds in the order of their report.
_ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
STRONG = ("assign", "access", "hex")
WEAK = ("login", "key40", "endpoint")
KINDS = STRONG + WEAK
PATTERNS = {
    "assign": rf"(?i){_ASSIGN}[A-Za-z0-9+/_.=-]+",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "login": r"""(?i)(?<![A-Za-z0-9])(?:user_?name|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.+-]{3,}""",
    "key40": r"(?<![A-Za-z0-9/+=])(?=[A-Za-z0-9/+]*[A-Z])(?=[A-Za-z0-9/+]*[a-z])(?=[A-Za-z0-9/+]*[0-9])"
    r"[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])",
    "endpoint": r"""(?i)(?<![A-Za-z0-9])[a-z][a-z0-9+.-]{1,15}://[^\s"'<>]{4,}""",
}
# Characters of a value that counts; shorter ones are matched, then dropped.
_VALUE_MIN = 6


def _pieces(text: Column, kind: str) -> Column:
    """array<struct<before, size, ok>>: characters before each match, its own, whether it counts."""
    pattern = F.lit(PATTERNS[kind])
    none = F.array().cast("array<struct<before:int,size:int,ok:boolean>>")
    between = F.split(text, PATTERNS[kind], -1)

    def one(match: Column, gap: Column) -> Column:
        ok = F.lit(True)
        if kind == "assign":
            # The value is what follows the longest head that leaves a value at all.
            value = F.length(match) - F.length(F.regexp_extract(match, rf"(?i)\A{_ASSIGN}(?=[A-Za-z0-9+/_.=-])", 0))
            ok = value >= _VALUE_MIN
        return F.struct(F.length(gap).alias("before"), F.length(match).alias("size"), ok.alias("ok"))

    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    found = F.zip_with(matches, F.slice(between, 1, F.size(matches)), one)
    return F.when(F.rlike(text, pattern), found).otherwise(none)


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row: (row, doc_id, key, one array per kind), written once; it holds no text."""
    text = F.coalesce(col(text_col), F.lit(""))
    return stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(id_col).cast("long").alias("doc_id"),
            text_key(id_col, text_col).alias("key"),
            *[_pieces(text, k).alias(k) for k in KINDS],
        ),
        "secret-pieces",
    )


def _placed(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end): running sums turn lengths into places."""
    some = scanned.where(" or ".join(f"size(`{k}`) > 0" for k in KINDS))
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), F.col(k).alias("pieces")) for n, k in enumerate(KINDS)])
    one = some.select("row", F.explode(kinds).alias("k")).select("row", "k.kind", F.posexplode("k.pieces").alias("i", "p"))
    so_far = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("p.before") + F.col("p.size")).over(so_far).cast("int")
    ends = one.withColumn("end", end).where("p.ok")
    return ends.select("row", "kind", (F.col("end") - F.col("p.size")).alias("start"), "end")


def _beside(weak: DataFrame, parts: DataFrame, kinds: tuple[str, ...], scope: int) -> DataFrame:
    """Interval join: the weak spans that have a part of one of ``kinds`` within ``scope``."""
    numbers = [KINDS.index(k) for k in kinds]
    others = parts.where(F.col("kind").isin(numbers)).select(
        F.col("row").alias("o_row"), F.col("start").alias("o_start"), F.col("end").alias("o_end")
    )
    # A complement stands in every bin from which it can be reached; spans are short, so these are few.
    first = F.floor((F.col("o_start") - scope) / scope)
    others = others.withColumn("o_bin", F.explode(F.sequence(first, F.floor((F.col("o_end") + scope) / scope))))
    near = (F.col("start") - F.col("o_end") <= scope) & (F.col("o_start") - F.col("end") <= scope)
    bins = weak.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))))
    joined = bins.join(others, (F.col("row") == F.col("o_row")) & (F.col("bin") == F.col("o_bin")) & near, "left_semi")
    return joined.select("row", "kind", "start", "end").distinct()


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """Weak spans whose complements stand within the scope."""

    def of(kind: str) -> DataFrame:
        return parts.where(F.col("kind") == KINDS.index(kind))

    login = _beside(of("login"), parts, ("assign", "key40"), scope)
    key = _beside(of("key40"), parts, ("access", "login"), scope)
    endpoint = _beside(of("endpoint"), parts, ("access", "login"), scope)
    endpoint = _beside(endpoint, parts, ("assign", "key40"), scope)
    return login.unionByName(key).unionByName(endpoint)


def _spans_per_row(scanned: DataFrame, scope: int) -> DataFrame:
    """(row, spans array<struct<start, kind, end>>), sorted; rows with a span only."""
    parts = stage(_placed(scanned), "secret-parts")
    strong = parts.where(F.col("kind") < len(STRONG))
    found = strong.unionByName(_linked(parts, scope))
    return found.groupBy(F.col("row").alias("s_row")).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")
    )


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE
) -> DataFrame:
    """(doc_id, spans array<struct<start, kind, end>>) for every row; kinds as numbers of ``KINDS``."""
    scanned = _scan(docs, id_col, text_col)
    spans = stage(_spans_per_row(scanned, scope), "secret-spans")
    none = F.array().cast(spans.schema["spans"].dataType)
    return scanned.select("row", "doc_id").join(spans, F.col("row") == F.col("s_row"), "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )


def _named(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def report(found: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of ``find_secrets``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < len(STRONG))
    return found.select(
        "doc_id", *[count(k) for k in STRONG], F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("spans")).alias("spans")
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (spans that overlap by one); ``n_chars`` follows, if there is one."""
    spans_col, id_name, key_name = fresh(docs, "spans"), fresh(docs, "s_id"), fresh(docs, "s_key")
    scanned = _scan(docs, id_col, text_col)
    found = scanned.join(_spans_per_row(scanned, scope), F.col("row") == F.col("s_row"))
    spans = found.dropDuplicates(["doc_id", "key"]).select(
        F.col("doc_id").alias(id_name), F.col("key").alias(key_name), F.col("spans").alias(spans_col)
    )
    spans = stage(spans, "secret-spans")
    (total,) = spans.agg(F.coalesce(F.sum(F.size(spans_col)), F.lit(0))).first()
    spans = sized(spans, 150, 32 * total)
    same = spans[id_name].eqNullSafe(docs[f"`{id_col}`"].cast("long")) & (spans[key_name] == text_key(id_col, text_col))
    joined = docs.join(spans, same, "left")
    text = col(text_col)
    # Spans come sorted by start. Where one begins behind all before it, the text between is kept.
    reach = F.aggregate(
        spans_col,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")
        ),
    )
    pieces = F.zip_with(
        spans_col,
        reach["all"],
        lambda s, before: F.when(
            (s["start"] >= before) & ((s["start"] > before) | (before == 0)),
            F.concat(text.substr(before + 1, s["start"] - before), F.lit(mask)),
        ).otherwise(F.lit("")),
    )
    changed = F.concat(F.array_join(pieces, ""), text.substr(reach["at"] + 1, F.length(text)))
    out = joined.withColumn(text_col, F.when(F.col(spans_col).isNotNull(), changed).otherwise(text))
    if "n_chars" in docs.columns:
        size = F.length(col(text_col)).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(spans_col).isNotNull(), size).otherwise(col("n_chars")))
    return out.select(*[col(c) for c in docs.columns])

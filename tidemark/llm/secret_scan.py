"""Secret scans: known shapes by pattern, others by a battery of randomness tests.

DataFrame and SQL functions only. A text is read once; candidates become rows. A token in an
encoding's alphabet is taken for random if none of three tests speaks against it: chi-squared
uniformity of the alphabet (in equal bins), runs above and below the middle, and serial
correlation. Tests that speak against randomness are declared with a bounded rate of false
discoveries among all tokens of a similar length, so that short tokens, whose tests are weak,
do not set the threshold of long ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import stage

KINDS = ("assign", "access", "hex", "random")

# The shapes of the contract, in the pattern language that Java and RE2 share.
PATTERNS = {
    "assign": (
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
    "random": r"[A-Za-z0-9+/_-]{20,}",
}
MIN_VALUE = 8
#: Rate of false discoveries among the tokens declared ordinary.
FALSE_DISCOVERIES = 0.05
MASK = "[secret]"

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encoding: the pattern that infers it, its symbols in order, and the number of equal bins.
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef", 8),
    "base32": (r"^[A-Z2-7]*[2-7][A-Z2-7]*$", _UPPER + "234567", 8),
    "base36": (r"^[a-z0-9]*[0-9][a-z0-9]*$", _DIGITS + _LOWER, 6),
    "base64": (None, _UPPER + _LOWER + _DIGITS + "+/", 8),
}


def encoding_sql(token: str = "token") -> str:
    """SQL of the inferred encoding; null for words and other tokens of no encoding.

    Written with functions that mean the same to Spark and DuckDB.
    """
    cases = [f"WHEN regexp_like_({token}, '{pattern}') THEN '{name}'" for name, (pattern, _, _) in ENCODINGS.items() if pattern]
    mixed = " AND ".join(f"regexp_like_({token}, '[{part}]')" for part in ("A-Z", "a-z", "0-9"))
    return f"CASE {' '.join(cases)} WHEN {mixed} THEN 'base64' END"


def bins_sql(token: str = "token", encoding: str = "encoding") -> str:
    """SQL of the token with each symbol replaced by the digit of its bin."""
    cases = []
    for name, (_, symbols, bins) in ENCODINGS.items():
        digits = "".join(str(i * bins // len(symbols)) for i in range(len(symbols)))
        source = f"lower({token})" if name == "hex" else f"translate({token}, '-_', '+/')" if name == "base64" else token
        cases.append(f"WHEN '{name}' THEN translate({source}, '{symbols}', '{digits}')")
    return f"CASE {encoding} {' '.join(cases)} END"


def _upper_tail(z: str) -> str:
    """Probability that a normal variable exceeds ``z``, to seven decimals."""
    t = f"(1.0e0 / (1.0e0 + 0.2316419e0 * abs({z})))"
    series = f"{t} * (0.319381530e0 + {t} * (-0.356563782e0 + {t} * (1.781477937e0 + {t} * (-1.821255978e0 + {t} * 1.330274429e0))))"
    tail = f"(0.3989422804014327e0 * exp(-0.5e0 * ({z}) * ({z})) * {series})"
    return f"CASE WHEN ({z}) >= 0 THEN {tail} ELSE 1.0e0 - {tail} END"


def score_sql(columns: dict[str, str]) -> dict[str, str]:
    """SQL of the normal scores of the three tests, from the columns the engine's own code counts.

    ``columns`` names: n, k (bins), squares (of bin counts), high (symbols in the upper bins),
    turns (changes between lower and upper), total, squared, product (sum, squares and circular
    products of neighbours of the bin numbers).
    """
    n, k, squares, high, turns = (f"CAST({columns[c]} AS DOUBLE)" for c in ("n", "k", "squares", "high", "turns"))
    total, squared, product = (f"CAST({columns[c]} AS DOUBLE)" for c in ("total", "squared", "product"))
    free = f"({k} - 1.0e0)"
    chi = f"({squares} * {k} / {n} - {n})"
    chi_z = f"(power(greatest({chi}, 0.0e0) / {free}, 1.0e0 / 3.0e0) - (1.0e0 - 2.0e0 / (9.0e0 * {free}))) / sqrt(2.0e0 / (9.0e0 * {free}))"
    mean = f"(2.0e0 * {high} * ({n} - {high}) / {n} + 1.0e0)"
    spread = f"(({mean} - 1.0e0) * ({mean} - 2.0e0) / ({n} - 1.0e0))"
    runs_z = f"CASE WHEN {spread} > 0 THEN abs({turns} + 1.0e0 - {mean}) / sqrt({spread}) ELSE 9.0e0 END"
    bottom = f"({n} * {squared} - {total} * {total})"
    level = f"(1.0e0 / ({n} - 1.0e0))"
    wide = f"({n} / (({n} - 1.0e0) * sqrt({n} - 2.0e0)))"
    serial_z = f"CASE WHEN {bottom} > 0 THEN abs(({n} * {product} - {total} * {total}) / {bottom} + {level}) / {wide} ELSE 9.0e0 END"
    return {"chi_z": chi_z, "runs_z": runs_z, "serial_z": serial_z}


def p_sql() -> str:
    """SQL of the combined probability in thousandths: three times the smallest of the tests."""
    tails = [_upper_tail("chi_z"), f"2.0e0 * ({_upper_tail('runs_z')})", f"2.0e0 * ({_upper_tail('serial_z')})"]
    least = f"least({', '.join(tails)})"
    return f"CAST(floor(1000.0e0 * least(1.0e0, 3.0e0 * {least})) AS INT)"


def _tested(tokens: DataFrame) -> DataFrame:
    """``encoding``, ``p`` (thousandths) and ``band`` (binary logarithm of the length) of each ``token``."""
    def here(sql: str) -> Column:
        return F.expr(sql.replace("regexp_like_", "regexp_like"))

    keep = tokens.columns
    found = tokens.select(*keep, here(encoding_sql()).alias("encoding"))
    binned = found.select(*keep, "encoding", F.expr(bins_sql()).alias("_b"))
    bins = F.lit(None).cast("int")
    for name, (_, _, k) in ENCODINGS.items():
        bins = F.when(F.col("encoding") == name, k).otherwise(bins)
    n = F.length("_b")
    counts = [n - F.length(F.replace("_b", F.lit(str(k)), F.lit(""))) for k in range(8)]
    half = F.when(F.col("encoding") == "base36", F.translate("_b", "012345", "000111")).otherwise(
        F.translate("_b", "01234567", "00001111")
    )
    digits = F.transform(F.split("_b", ""), lambda x: x.cast("long"))
    counted = binned.select(
        *keep, "encoding", n.alias("_n"), bins.alias("_k"), half.alias("_half"), F.array(*counts).alias("_counts"),
        F.when(F.col("_b").isNotNull(), digits).alias("_x"),
    )
    add = lambda total, x: total + x
    zero = F.lit(0).cast("long")
    turned = F.concat(F.slice("_x", 2, F.greatest(F.size("_x"), F.lit(0))), F.slice("_x", 1, 1))
    changes = sum(
        (F.length("_half") - F.length(F.replace("_half", F.lit(pair), F.lit("")))) / 2 for pair in ("01", "10")
    )
    summed = counted.select(
        *keep, "encoding", "_n", "_k",
        F.aggregate(F.transform("_counts", lambda c: c.cast("long") * c), zero, add).alias("_squares"),
        F.length(F.replace("_half", F.lit("0"), F.lit(""))).alias("_high"), changes.alias("_turns"),
        F.aggregate("_x", zero, add).alias("_total"),
        F.aggregate(F.transform("_x", lambda x: x * x), zero, add).alias("_squared"),
        F.aggregate(F.zip_with("_x", turned, lambda x, y: x * y), zero, add).alias("_product"),
    )
    names = {c: f"_{c}" for c in ("n", "k", "squares", "high", "turns", "total", "squared", "product")}
    scored = summed.select(*keep, "encoding", "_n", *[F.expr(s).alias(c) for c, s in score_sql(names).items()])
    return scored.select(
        *keep, "encoding",
        F.expr(p_sql()).alias("p"), F.floor(F.log2("_n")).cast("int").alias("band"),
    )


def thresholds(tested: DataFrame) -> DataFrame:
    """``band`` and ``limit``: tokens with ``p`` at or below it are declared ordinary.

    Step-up control of the false discovery rate. Probabilities are thousandths, so that one
    count per band and thousandth, a bounded table, stands for all tokens.
    """
    counts = tested.where("encoding IS NOT NULL").groupBy("band", "p").agg(F.count("*").alias("n"))
    band = Window.partitionBy("band")
    steps = counts.select(
        "band", "p",
        F.sum("n").over(band.orderBy("p").rowsBetween(Window.unboundedPreceding, 0)).alias("up_to"),
        F.sum("n").over(band).alias("all"),
    )
    passed = F.col("p") * F.col("all") <= F.lit(int(FALSE_DISCOVERIES * 1000)) * F.col("up_to")
    return steps.groupBy("band").agg(F.coalesce(F.max(F.when(passed, F.col("p"))), F.lit(-1)).alias("limit"))


def _numbered(order: int):
    return lambda pair, i: F.struct(
        F.lit(order).alias("kind"), i.alias("i"), pair.getField("before").alias("before"), pair.getField("token").alias("token")
    )


def matches(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row`` and ``_found``: kind, number, length before and token of each match."""
    kept = F.struct(*[docs[name] for name in docs.columns]).alias("_doc")
    found = docs.select(kept, F.coalesce("text", F.lit("")).alias("_text")).select(
        "*", *[F.regexp_extract_all("_text", F.lit(PATTERNS[kind]), F.lit(0)).alias(f"_{kind}") for kind in KINDS]
    )
    arrays = []
    for order, kind in enumerate(KINDS):
        before = F.transform(F.split("_text", PATTERNS[kind], -1), lambda piece: F.char_length(piece))
        pairs = F.zip_with(
            F.slice(before, 1, F.size(f"_{kind}")), F.col(f"_{kind}"),
            lambda b, m: F.struct(b.alias("before"), m.alias("token")),
        )
        numbered = F.transform(pairs, _numbered(order))
        empty = F.array().cast("array<struct<kind:int,i:int,before:int,token:string>>")
        # Texts are split only where there is a match.
        arrays.append(F.when(F.size(f"_{kind}") > 0, numbered).otherwise(empty))
    return found.select(
        F.monotonically_increasing_id().alias("_row"), "_doc", F.concat(*arrays).alias("_found")
    )


def _value(token: str = "token") -> Column:
    return F.regexp_extract(token, PATTERNS["assign"], 2)


def _spans(rows: DataFrame) -> DataFrame:
    """``_row`` and ``secrets`` of the rows of ``matches`` (stored, so that ``_row`` is fixed)."""
    each = rows.where(F.size("_found") > 0).select("_row", F.inline("_found"))
    width = F.char_length("token")
    order = Window.partitionBy("_row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("before") + width).over(order).cast("int")).select(
        "_row", "kind", (F.col("end") - width).alias("start"), "end", "token"
    )
    placed = placed.where((F.col("kind") != 0) | (F.char_length(_value()) >= MIN_VALUE))
    tested = stage(
        _tested(placed.withColumn("token", F.when(F.col("kind") == 3, F.col("token")))).drop("token"), "spans"
    )
    limits = thresholds(tested)
    random = tested.where("encoding IS NOT NULL").join(F.broadcast(limits), "band").where("p > limit")
    spans = tested.where("kind < 3").select("_row", "start", "kind", "end").union(
        random.select("_row", "start", "kind", "end")
    )
    before = Window.partitionBy("_row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before)
    own = spans.withColumn("_reach", reach).where("kind < 3 OR _reach IS NULL OR _reach < end")
    return own.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("secrets"))


def secret_spans(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id`` and ``secrets``, the spans (start, kind, end) in order.

    Starts and ends count code points; ``kind`` is a number into ``KINDS``. Spans of the three
    known shapes do not overlap within a kind; a random token within one of them is left out.
    Null and empty texts have no spans; every row counts for itself, repeated ones too; an empty
    table gives an empty result; other columns are ignored.
    """
    rows = matches(docs.select("doc_id", "text")).select("_row", "_doc.doc_id", "_found")
    rows = stage(rows, "secrets")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return rows.select("_row", "doc_id").join(_spans(rows), "_row", "left").select(
        "doc_id", F.coalesce("secrets", none).alias("secrets")
    )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.getField("kind")), s.getField("start"), s.getField("end"))),
        ",",
    )


def _is(kind: int):
    return lambda s: F.when(s.getField("kind") == kind, 1)


def secret_digest(spans: DataFrame) -> DataFrame:
    """Counts per known shape, a digest of their spans, and all spans as text."""
    known = F.filter("secrets", lambda s: s.getField("kind") < 3)
    return spans.select(
        "doc_id",
        *[F.array_size(F.array_compact(F.transform("secrets", _is(k)))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_joined(known).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secrets")).alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``secret_spans`` in ``text`` replaced by ``MASK``.

    All rows and all other columns stay as they are. Spans that overlap are masked together.
    Null texts stay null. Only rows with a match are joined with their spans; the others keep
    their place.
    """
    rows = stage(matches(docs), "redact")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        at, out = done.getField("at"), done.getField("out")
        clear = F.substring(F.col("_doc.text"), at + 1, F.greatest(span.getField("start") - at, F.lit(0)))
        mask = F.when(span.getField("end") <= at, "").when(span.getField("start") < at, "").otherwise(MASK)
        return F.struct(
            F.greatest(at, span.getField("end")).alias("at"), F.concat(out, clear, mask).alias("out")
        )

    def finish(done: Column) -> Column:
        return F.concat(done.getField("out"), F.substring(F.col("_doc.text"), done.getField("at") + 1, F.lit(2**31 - 1)))

    hit = rows.where(F.size("_found") > 0).join(_spans(rows), "_row", "left")
    masked = F.when(F.size("secrets") > 0, F.aggregate("secrets", start, step, finish)).otherwise(F.col("_doc.text"))
    columns = [F.col("_doc").getField(name).alias(name) for name in docs.columns]
    changed = [masked.alias(name) if name == "text" else c for name, c in zip(docs.columns, columns)]
    return rows.where(F.size("_found") == 0).select(*columns).union(hit.select(*changed))

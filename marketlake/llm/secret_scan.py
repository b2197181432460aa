"""Secrets in texts: fixed patterns, and tokens that pass a battery of randomness tests. DataFrame functions only.

A token of 20 or more characters has an inferred encoding (hexadecimal, base 32, base 36, base 64 or letters only),
whose alphabet gives its characters numbers. Its parts between separators, and what follows a leading word, are tested too. Three tests take "every character is drawn evenly and by itself" as
their hypothesis: chi-squared over the alphabet, runs of the alphabet's halves, and lag-1 serial correlation. Fisher's method makes one
p-value of the three. Words and identifiers have tiny p-values, random keys have evenly spread ones.

A token is reported if its p-value is above a threshold that depends on encoding and length: with ``N(p > 0.5)`` tokens in
a band of lengths, about ``2 (1 - c) N(p > 0.5)`` random ones lie above c; the rest of those above c are false. The
threshold is the lowest c down to which at most ``FALSE_SHARE`` are, give or take one standard deviation of the count.
Short tokens, whose tests are weak, thus need more. The counts are of distinct tokens over all texts, so copies of one token
decide nothing; a band with few of them is judged with its neighbours.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.graph import written

# The kinds in their order and the patterns of the base detectors.
KINDS = ("assign", "access", "hex", "random")
PATTERNS = {
    "assign": r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
}
KEYWORD = r"(?i:password|passwd|secret|token|api_?key)"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
# Parts of a token: between separators, and behind a leading word.
PARTS = {
    r"[A-Za-z0-9]{20,}": 0,
    r"[A-Za-z0-9+/]{20,}": 0,
    r"[A-Za-z0-9_-]{20,}": 0,
    r"[A-Za-z0-9+/_-]{20,}": 0,
    r"(?<![A-Za-z0-9+/_=-])[+/_=-]*[A-Za-z]+[+/_=-]+([A-Za-z0-9+/_=-]{20,})": 1,
}
LEAST = 20
FALSE_SHARE = 0.05
BINS = 50
# A band with fewer distinct tokens takes those of neighbouring lengths along; an encoding with fewer is reported from this bin on.
FEW_TOKENS = 20
FEW_BIN = BINS // 10
REDACTED = "[REDACTED]"

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _zip(*arrays: str) -> str:
    """SQL of the arrays as one of structs with fields _0, _1, ..."""
    named = ", ".join(f"'_{i}', {a}" for i, a in enumerate(arrays))
    return f"element_at(transform(array(named_struct({named})), w -> arrays_zip({', '.join(f'w._{i}' for i in range(len(arrays)))})), 1)"


def _running(values: str, step: str, start: str) -> str:
    """SQL of what ``step`` (of a and v) makes of the values before each place of an array, and of all: one more than there are.

    Running results over blocks of about the square root of the values, then within each, so the work is the values times that root.
    """
    blocks = "sequence(0, (size(p.l) - 1) div p.k)"
    return f"""element_at(transform(transform(transform(
      array(named_struct('l', concat(array({start}), {values}))),
      p -> named_struct('l', p.l, 'k', CAST(ceil(sqrt(size(p.l))) AS INT))),
      p -> named_struct('l', p.l, 'k', p.k, 's', transform({blocks}, b -> aggregate(slice(p.l, b * p.k + 1, p.k), {start}, (a, v) -> {step})))),
      p -> flatten(transform({blocks}, b -> element_at(transform(array(aggregate(slice(p.s, 1, b), {start}, (a, v) -> {step})), f ->
        transform(sequence(0, least(p.k, size(p.l) - b * p.k) - 1), i -> aggregate(slice(p.l, b * p.k + 1, i + 1), f, (a, v) -> {step}))), 1)))), 1)"""


def _sum(values: str) -> str:
    return _running(values, "a + v", "0")


def _greatest(values: str) -> str:
    return _running(values, "greatest(a, v)", "-1")


def _below(points: str, queries: str) -> str:
    """SQL of how many of ``points`` are less than each of ``queries``, by sorting both together."""
    events = f"""array_sort(concat(transform({queries}, (q, i) -> named_struct('at', q, 'point', 0, 'i', i)),
      transform({points}, x -> named_struct('at', x, 'point', 1, 'i', 0))))"""
    counted = _sum("transform(e.x, x -> x.point)")
    return f"""element_at(transform(transform(array(named_struct('x', {events})), e -> named_struct('x', e.x, 'n', {counted})),
      e -> transform(array_sort(transform(filter({_zip("e.x", "slice(e.n, 1, size(e.x))")}, z -> z._0.point = 0),
        z -> named_struct('i', z._0.i, 'n', z._1))), z -> z.n)), 1)"""


def _outside(tokens: str, spans: str) -> str:
    """SQL of the ``tokens`` (start, end) that overlap none of the ``spans``: as many of these begin before the token's end as end before its start."""
    begun = _below(f"transform({spans}, s -> s.start)", f"transform({tokens}, t -> t.end)")
    over = _below(f"transform({spans}, s -> s.end)", f"transform({tokens}, t -> t.start + 1)")
    return f"transform(filter({_zip(tokens, begun, over)}, z -> z._1 = z._2), z -> z._0)"


def _distinct(spans: str, known: str) -> str:
    """SQL of the distinct ``spans`` (start, end, ...) but for those among ``known``, by sorting both and looking at neighbours."""
    both = f"""array_sort(concat(transform({known}, x -> named_struct('start', x.start, 'end', x.end, 'own', 0, 'x', x)),
      transform({spans}, x -> named_struct('start', x.start, 'end', x.end, 'own', 1, 'x', x))))"""
    before = "concat(array(CAST(NULL AS INT)), transform(slice(d.s, 1, greatest(size(d.s) - 1, 0)), x -> {}))"
    fresh = "z._0.own = 1 AND (z._1 IS NULL OR z._1 <> z._0.start OR z._2 <> z._0.end)"
    found = f"transform(filter({_zip('d.s', before.format('x.start'), before.format('x.end'))}, z -> z._0 IS NOT NULL AND {fresh}), z -> z._0.x)"
    return f"element_at(transform(array(named_struct('s', {both})), d -> {found}), 1)"


def _located(kind: int, keep: str, token: bool = False) -> Column:
    """Spans of the matches ``m`` between the gaps ``g``, which begin at ``at``; only those where ``keep`` (of x.m, x.v) holds."""
    more = ", 'token', x.v" if token else ""
    begin = "x.at + length(x.g) + length(x.m) - length(x.v)" if token else "x.at + length(x.g)"
    return F.expr(f"""transform(filter(arrays_zip(g, m, v, at), x -> x.m IS NOT NULL AND {keep}),
      x -> named_struct('start', {begin}, 'kind', {kind}, 'end', x.at + length(x.g) + length(x.m){more}))""")


def _matches(df: DataFrame, name: str, pattern: str, seen: Column, value: int, located: Column) -> DataFrame:
    """Add the spans of a pattern; texts in which it is not ``seen`` are not cut."""
    text = F.col("_text")
    none = F.lit(None).cast("array<string>")
    df = df.withColumn("seen", seen)
    df = df.withColumn("m", F.when(F.col("seen"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("g", F.when(F.col("seen"), F.split(text, pattern, -1)).otherwise(none))
    df = df.withColumn("v", F.when(F.col("seen"), F.regexp_extract_all(text, F.lit(pattern), F.lit(value))).otherwise(none) if value else F.col("m"))
    sizes = "transform(arrays_zip(g, m), x -> length(x.g) + coalesce(length(x.m), 0))"
    df = df.withColumn("at", F.when(F.col("seen"), F.expr(f"slice({_sum(sizes)}, 1, size(g))")))
    return df.withColumn(name, located).drop("seen", "m", "g", "v", "at")


def _upper_tail(z: str) -> str:
    """The standard normal's upper tail, by a logistic of a cubic; off by 0.0002 at most."""
    return f"1 / (1 + exp(least(700D, greatest(-700D, 1.5976D * ({z}) + 0.070565992D * pow({z}, 3)))))"


# Encodings as the size of their alphabet, and hundreds that tell apart those of one size.
_FORM = """CASE WHEN NOT (t.token RLIKE '[0-9]' AND t.token RLIKE '[A-Za-z]') THEN NULL
                       WHEN replace(t.token, '-', '') RLIKE '^([0-9a-f]+|[0-9A-F]+)$' THEN 16
                       WHEN t.token RLIKE '^[A-Z2-7]+=*$' THEN 32
                       WHEN t.token RLIKE '^[a-z0-9]+$' THEN 36
                       WHEN t.token RLIKE '[a-z]' AND t.token RLIKE '[A-Z]' THEN 64 END"""
# Upper-case base 36, base 36 with separators, and letters only.
_MORE_FORMS = f"""coalesce({_FORM}, CASE WHEN t.token RLIKE '[0-9]' AND t.token RLIKE '^[A-Z0-9]+$' THEN 136
                       WHEN t.token RLIKE '[0-9]' AND t.token RLIKE '^[a-z0-9+/_=-]+$' AND t.token RLIKE '[a-z]' THEN 236
                       WHEN t.token RLIKE '[0-9]' AND t.token RLIKE '^[A-Z0-9+/_=-]+$' AND t.token RLIKE '[A-Z]' THEN 336
                       WHEN t.token RLIKE '^[a-z]+$' THEN 26
                       WHEN t.token RLIKE '^[A-Z]+$' THEN 126
                       WHEN t.token RLIKE '^[A-Za-z]+$' THEN 52
                       WHEN t.token RLIKE '[a-z]' AND t.token RLIKE '[A-Z]' THEN 64 END)"""


def _tested(df: DataFrame, tokens: str, forms: str, name: str, hashes: str) -> DataFrame:
    """``tokens`` (start, kind, end, token) become ``name`` (start, end, band of encoding and length, p-value bin) and their ``hashes``."""
    step = df.withColumn(
        "c",
        F.expr(f"""filter(transform(coalesce({tokens}, array()), t -> named_struct('start', t.start, 'end', t.end, 'token', t.token, 'hash', xxhash64(t.token),
          'form', {forms})), t -> t.form IS NOT NULL)"""),
    )
    step = step.withColumn(
        "c",
        F.expr("""transform(c, t -> named_struct('start', t.start, 'end', t.end, 'hash', t.hash, 'form', t.form, 'x', transform(
          filter(split(CASE WHEN t.form = 16 THEN replace(lower(t.token), '-', '') WHEN t.form = 64 THEN translate(t.token, '-_', '+/')
            WHEN t.form > 100 THEN translate(lower(t.token), '+/_=-', '') ELSE t.token END, ''), s -> s NOT IN ('', '=')),
          s -> CAST(locate(s, CASE t.form % 100 WHEN 16 THEN '0123456789abcdef' WHEN 32 THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
            WHEN 36 THEN 'abcdefghijklmnopqrstuvwxyz0123456789' WHEN 26 THEN 'abcdefghijklmnopqrstuvwxyz'
            ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END) - 1 AS DOUBLE))))"""),
    )
    step = step.withColumn("c", F.expr(f"filter(c, t -> size(t.x) >= {LEAST})"))
    step = step.withColumn(
        "c",
        F.expr("""transform(c, t -> named_struct('start', t.start, 'end', t.end, 'hash', t.hash, 'form', t.form, 'x', t.x, 'n', CAST(size(t.x) AS DOUBLE),
          'mean', aggregate(t.x, 0D, (a, v) -> a + v) / size(t.x),
          'square', aggregate(sequence(0, (t.form % 100) - 1), 0D, (a, k) -> a + pow(size(filter(t.x, v -> v = k)), 2)),
          'high', CAST(size(filter(t.x, v -> 2 * v >= (t.form % 100))) AS DOUBLE)))"""),
    )
    step = step.withColumn(
        "c",
        F.expr("""transform(c, t -> named_struct('start', t.start, 'end', t.end, 'hash', t.hash, 'form', t.form, 'n', t.n,
          'chi', (t.form % 100) / t.n * t.square - t.n,
          'product', 2 * t.high * (t.n - t.high),
          'runs', 1 + aggregate(zip_with(t.x, slice(t.x, 2, size(t.x)), (v, w) -> if(w IS NOT NULL AND (2 * v >= (t.form % 100)) <> (2 * w >= (t.form % 100)), 1D, 0D)), 0D, (a, v) -> a + v),
          'serial', aggregate(zip_with(t.x, slice(t.x, 2, size(t.x)), (v, w) -> coalesce((v - t.mean) * (w - t.mean), 0D)), 0D, (a, v) -> a + v)
             / nullif(aggregate(t.x, 0D, (a, v) -> a + (v - t.mean) * (v - t.mean)), 0D)))"""),
    )
    # Wilson and Hilferty's cube root for chi-squared; a token without variation fails its tests.
    chi = "(pow(greatest(t.chi, 0D) / ((t.form % 100) - 1), 1 / 3D) - (1 - 2 / (9D * ((t.form % 100) - 1)))) / sqrt(2 / (9D * ((t.form % 100) - 1)))"
    runs = "abs(t.runs - t.product / t.n - 1) / sqrt(nullif(t.product * (t.product - t.n) / (t.n * t.n * (t.n - 1)), 0D))"
    serial = "abs(t.serial + 1 / t.n) * sqrt(t.n)"
    tails = [_upper_tail(chi), f"2 * {_upper_tail(runs)}", f"2 * {_upper_tail(serial)}"]
    total = " + ".join(f"-ln(least(1D, greatest(1e-300D, coalesce({p}, 0D))))" for p in tails)
    step = step.withColumn("c", F.expr(f"transform(c, t -> named_struct('start', t.start, 'end', t.end, 'hash', t.hash, 'form', t.form, 'n', t.n, 's', {total}))"))
    return step.withColumn(
        name,
        F.expr(f"""transform(c, t -> named_struct('start', t.start, 'end', t.end, 'band', t.form * 1000 + CAST(floor(4 * log2(t.n)) AS INT),
          'bin', CAST(least({BINS - 1}, floor({BINS} * exp(-t.s) * (1 + t.s + t.s * t.s / 2))) AS INT)))"""),
    ).withColumn(hashes, F.expr("transform(c, t -> t.hash)")).drop("c")


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` spans (start, kind, end; sorted) and ``tested`` tokens of every whole text, and ``parts`` of tokens tested likewise."""
    text = F.col("_text")
    df = docs.withColumn("_text", F.coalesce("text", F.lit("")))
    df = _matches(df, "_assign", PATTERNS["assign"], text.rlike(KEYWORD), 2, _located(0, "length(x.v) >= 6"))
    df = _matches(df, "_access", PATTERNS["access"], text.contains("AKIA"), 0, _located(1, "length(x.m) >= 20"))
    df = _matches(df, "_hex", PATTERNS["hex"], text.rlike("[0-9a-f]{24}"), 0, _located(2, "true"))
    df = _matches(df, "tokens", TOKEN, text.rlike(TOKEN.replace(",}", "}")), 0, _located(3, "true", token=True))
    for i, (pattern, value) in enumerate(PARTS.items()):
        df = _matches(df, f"_part{i}", pattern, F.size("tokens") > 0, value, _located(3, "true", token=True))
    parts = ["tokens", *(f"_part{i}" for i in range(len(PARTS)))]
    empty = "CAST(array() AS array<struct<start:int,kind:int,end:int,token:string>>)"
    every = f"concat({', '.join(f'coalesce({c}, {empty})' for c in parts)})"
    df = df.withColumn("more", F.expr(_distinct(every, f"filter(coalesce(tokens, {empty}), t -> ({_FORM}) IS NOT NULL)")))
    none = F.expr(f"cast(array() AS {_SPAN})")
    df = df.withColumn("base", F.array_sort(F.concat(*[F.coalesce(c, none) for c in ("_assign", "_access", "_hex")])))
    df = _tested(_tested(df, "tokens", _FORM, "tested", "hashes"), "more", _MORE_FORMS, "parts", "part_hashes")
    return df.drop("_assign", "_access", "_hex", "_text", "more", *parts)


def _lowest(n: list[int]) -> int:
    upper = above = sum(n[BINS // 2 :])
    at = BINS // 2 if upper else BINS
    for b in range(BINS // 2 - 1, 0, -1):
        above += n[b]
        false = above - 2 * (1 - b / BINS) * upper
        if not upper or false - above**0.5 > FALSE_SHARE * above:
            break
        at = b
    return at


def thresholds(known: DataFrame) -> dict[int, int]:
    """The lowest p-value bin reported, by band (encoding and length), from the counts of all distinct tokens.

    There are a few encodings and four bands for each doubling of the length, so the rows fetched are few.
    """
    tested, hashes = F.concat("tested", "parts").alias("tested"), F.concat("hashes", "part_hashes").alias("hashes")
    tokens = known.select(tested, hashes).select(F.explode(F.arrays_zip("tested", "hashes")).alias("t")).select("t.tested.band", "t.tested.bin", "t.hashes")
    counts = tokens.distinct().groupBy("band", "bin").count().toArrow().to_pylist()
    bands: dict[int, list[int]] = {}
    for row in counts:
        bands.setdefault(row["band"], [0] * BINS)[row["bin"]] += row["count"]
    lowest = {}
    for band in bands:
        near = sorted((other for other in bands if other // 1000 == band // 1000), key=lambda other: abs(other - band))
        n = [0] * BINS
        for other in near:
            if sum(n) < FEW_TOKENS:
                n = [x + y for x, y in zip(n, bands[other], strict=True)]
        lowest[band] = _lowest(n) if sum(n) >= FEW_TOKENS else FEW_BIN
    return lowest


def with_spans(known: DataFrame) -> DataFrame:
    """Add ``spans`` (start, kind, end; sorted) to a written result of ``scanned``: base ones and random tokens outside them.

    Parts are added outside whole random tokens, and of nested ones the longest.
    """
    lowest = thresholds(known)
    table = F.create_map(*[F.lit(x) for pair in lowest.items() for x in pair]) if lowest else None

    def random(name: str) -> Column:
        return F.filter(name, lambda t: t["bin"] >= table[t["band"]] if lowest else F.lit(False))

    span = "CAST({} AS " + _SPAN + ")"
    spans = "transform({}, t -> named_struct('start', t.start, 'kind', 3, 'end', t.end))"
    step = known.withColumn("_random", random("tested")).withColumn("_parts", random("parts"))
    step = step.withColumn("spans", F.expr(f"concat(base, {span.format(spans.format(_outside('_random', 'base')))})"))
    step = step.withColumn("_parts", F.expr(_distinct(spans.format(_outside("_parts", "spans")), f"CAST(array() AS {_SPAN})")))
    # By start and then the longest: what ends no later than one before it lies within that one.
    step = step.withColumn("_parts", F.expr("array_sort(_parts, (x, y) -> CASE WHEN x.start <> y.start THEN x.start - y.start ELSE y.end - x.end END)"))
    furthest = f"slice({_greatest('transform(_parts, t -> t.end)')}, 1, size(_parts))"
    longest = f"transform(filter({_zip('_parts', furthest)}, z -> z._1 < z._0.end), z -> z._0)"
    step = step.withColumn("spans", F.expr(f"array_sort(concat(spans, {span.format(longest)}))"))
    return step.drop("_random", "_parts")


def _joined(spans: str) -> Column:
    kind = functools.reduce(lambda other, k: f"if(s.kind = {k}, '{KINDS[k]}', {other})", range(len(KINDS)), "''")
    return F.expr(f"array_join(transform({spans}, s -> concat({kind}, ':', s.start, ':', s.end)), ',')")


def _count(kind: int) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row of ``docs`` (doc_id, text, any further columns).

    Spans are ``kind:start:end`` in code points, end exclusive, by start and then kind. ``base_sha256`` is over those of the fixed
    patterns. A null or empty text has none; repeated rows and rows without a doc_id are scanned like
    others; an empty table has no rows.
    """
    known = written(scanned(docs.select("doc_id", "text")).drop("text"), "secrets")
    return with_spans(known).select(
        "doc_id",
        _count(0).alias("n_assign"),
        _count(1).alias("n_access"),
        _count(2).alias("n_hex"),
        F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] == 3)).cast("long").alias("n_random"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced; overlapping spans become one. Null texts stay null, columns as they were."""
    names = docs.columns
    others = F.struct(F.lit(True).alias("_"), *[F.col(n) for n in names if n != "text"])
    known = written(scanned(docs.select(others.alias("others"), "text")), "secrets")
    # Four bytes a character, so that a piece is cut without looking for where it begins.
    ends = _greatest("transform(spans, s -> s.end)")
    pieces = f"""element_at(transform(array(named_struct('b', encode(text, 'UTF-32'), 'n', length(text), 'p', {ends})), d ->
      array_join(transform(concat(
        transform(filter({_zip("transform(spans, s -> s.start)", "transform(slice(d.p, 1, size(spans)), e -> greatest(e, 0))")}, z -> z._0 >= z._1),
          z -> named_struct('from', z._1, 'to', z._0)),
        array(named_struct('from', element_at(d.p, -1), 'to', d.n))),
        w -> decode(substring(d.b, 4 * w.from + 1, 4 * (w.to - w.from)), 'UTF-32')), '{REDACTED}')), 1)"""
    clean = F.expr(pieces)
    text = F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))
    return with_spans(known).select(*[text.alias(n) if n == "text" else F.col("others")[n].alias(n) for n in names])

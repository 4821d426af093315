"""Secret scan: fixed patterns, and a randomness test battery for everything they do not name.

Patterns are found leftmost without overlap; a span's place follows from the lengths of the
text between the matches.  Every other token of at least ``min_token`` characters of the usual
encodings' alphabets is a candidate.  Its encoding is inferred from its characters, and three
statistics are taken over that alphabet:

* chi-squared of the character counts against a uniform alphabet,
* the number of runs (changes of character class for mixed alphabets, of the alphabet's halves else),
* the serial correlation at lag 1 of the alphabet positions.

A candidate stays if none of the three rejects randomness.  Its p-value is the chance that ordinary text of
its length and encoding looks as random: chi-squared (and, for mixed alphabets, class changes) against the means and variances
ordinary text has at that length, combined by Stouffer's sum, with an upper bound of the normal tail.
The Benjamini-Hochberg rule then bounds the false discoveries per encoding and length class, over
the candidates of all documents, from a histogram of p-values.

Defined cases: a null text is empty and has no span; rows are judged one by one, repeats alike; spans are sorted
by start, then kind; an empty table gives an empty table; a text of any length is judged whole, in time nearly
proportional to it (one task sorts its spans); only the id and the text are read, so other columns cannot clash.  The
battery refuses about 0.3 % of truly random tokens (three two-sided tests at 0.001).  DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.llm.common import cut

ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: kind, pattern, group whose length counts, least length, quick test that implies a match
PATTERNS = (("assign", ASSIGN, 2, 8, ASSIGN), ("access", ACCESS, 0, 16, r"AKIA[A-Z0-9]{12}"), ("hex", HEX, 0, 32, r"[0-9a-f]{32}"))
RANDOM = "random"
TOKEN = r"[A-Za-z0-9+/_=-]+"

#: encoding: (pattern, alphabet, chance that two characters of ordinary text agree)
ENCODINGS = {
    "digits": (r"^[0-9]+$", string.digits, 0.20),
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 0.15),
    "letters": (r"^(?:[A-Za-z]?[a-z]+|[A-Z]+)$", string.ascii_lowercase, 0.075),
    "base32": (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.075),
    "alnum": (r"^[A-Za-z0-9]+$", string.ascii_letters + string.digits, 0.07),
    "base64": (r"^[A-Za-z0-9+/]+=*$", string.ascii_letters + string.digits + "+/", 0.07),
    "base64url": (r"^[A-Za-z0-9_-]+=*$", string.ascii_letters + string.digits + "_-", 0.07),
    "mixed": (r"", string.ascii_letters + string.digits + "+/_-=", 0.07),
}
FOLDED = ("hex", "letters")  # one case only: compared in lower case
MIXED = ("base32", "alnum", "base64", "base64url", "mixed")
ORDINARY_CHANGES = 0.15  # class changes per character pair in ordinary tokens
VETO = 3.3  # a two-sided p-value of 0.001


RUN = 256
SPAN = "struct<start:int,end:int,kind:string>"
TOKEN_SPAN = "struct<start:int,end:int,token:string>"


def _spans(text: Column, kind: str, pattern: str, group: int, least: int, quick: str, with_text: bool = False) -> Column:
    """Array of (start, end, kind), or (start, end, token), of the matches whose ``group`` has ``least`` characters.

    Places are running sums of lengths.  They are summed up by runs of ``RUN`` matches first and then over the
    runs, so that a text with very many matches costs little more than its length.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.char_length(g))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.zip_with(
        F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(
            g.alias("gap"), F.char_length(m).alias("len"), (m if with_text else F.lit(kind)).alias("says"))),
        judged, lambda s, j: F.struct(s["gap"].alias("gap"), s["len"].alias("len"), s["says"].alias("says"), (F.char_length(j) >= least).alias("counts")))
    none = F.expr(f"cast(array() as array<{TOKEN_SPAN if with_text else SPAN}>)")
    # an element of an array of one is computed once, however often it is used below
    walked = F.flatten(F.transform(F.array(steps), lambda each: _walk(each, none, "token" if with_text else "kind")))
    return F.when(text.rlike(quick), walked).otherwise(none)


def _walk(steps: Column, none: Column, says: str) -> Column:
    runs = F.transform(F.sequence(F.lit(0), F.size(steps), F.lit(RUN)), lambda at: F.slice(steps, at + 1, F.lit(RUN)))
    local = F.transform(runs, lambda run: F.aggregate(
        run, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + s["gap"] + s["len"]).alias("at"),
            F.when(s["counts"], F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + s["gap"]).alias("start"), (acc["at"] + s["gap"] + s["len"]).alias("end"),
                s["says"].alias(says))))).otherwise(acc["out"]).alias("out"))))
    # where each run begins: the sums of the runs before it
    begins = lambda done: F.slice(F.aggregate(
        done, F.array(F.lit(0)), lambda acc, r: F.concat(acc, F.array(F.element_at(acc, -1) + r["at"]))), F.lit(1), F.size(done))
    joined = F.transform(F.array(local), lambda done: F.flatten(F.zip_with(
        done, begins(done), lambda r, begin: F.transform(r["out"], lambda s: F.struct(
            (s["start"] + begin).alias("start"), (s["end"] + begin).alias("end"), s[says].alias(says))))))
    return F.element_at(joined, 1)


def encoding_of(token: Column) -> Column:
    out = None
    for name, (pattern, _, _) in ENCODINGS.items():
        if pattern:
            out = F.when(token.rlike(pattern), name) if out is None else out.when(token.rlike(pattern), name)
    return out.otherwise("mixed")


def normal_tail(z: Column) -> Column:
    """An upper bound of P(Z > z), tight in the tail and exact at 0."""
    a = F.abs(z)
    upper = 2 * F.exp(-a * a / 2) / F.lit(2.5066282746310002) / (a + F.sqrt(a * a + 2.5464790894703255))
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _by_encoding(value) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, v in ENCODINGS.items() for x in (k, value(k, v))]), F.col("__enc"))


def _class_share(name: str, alphabet: str) -> float:
    """The chance that two characters of a uniform string are of one class (one half of the alphabet)."""
    if name not in MIXED:
        return 0.5
    classes = (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum())
    return sum((sum(map(of, alphabet)) / len(alphabet)) ** 2 for of in classes)


def battery(tokens: DataFrame) -> DataFrame:
    """Adds z_chi, z_runs, z_serial (against randomness) and z_ordinary (large: unlike ordinary text) to ``__token``."""
    mixed = F.col("__enc").isin(*MIXED)
    class_of = lambda c: (F.when(c.rlike("[a-z]"), 1).when(c.rlike("[A-Z]"), 2).when(c.rlike("[0-9]"), 3).otherwise(4))
    step1 = (tokens.withColumn("__enc", encoding_of(F.col("__token")))
             .withColumns({"__word": F.rtrim(F.when(F.col("__enc").isin(*FOLDED), F.lower("__token")).otherwise(F.col("__token")), F.lit("=")),
                           "__alphabet": _by_encoding(lambda k, v: v[1]), "__k": _by_encoding(lambda k, v: float(len(v[1]))),
                           "__agree": _by_encoding(lambda k, v: v[2]), "__same": _by_encoding(lambda k, v: _class_share(k, v[1]))})
             .withColumns({"__n": F.char_length("__word").cast("double"),
                           "__chars": F.filter(F.split("__word", ""), lambda c: c != ""),
                           "__letters": F.filter(F.split("__alphabet", ""), lambda c: c != "")})
             .where("__n >= 2"))
    step2 = step1.withColumns({
        "__squares": F.aggregate("__letters", F.lit(0.0), lambda acc, c: acc + F.pow(
            F.col("__n") - F.char_length(F.replace(F.col("__word"), c, F.lit(""))), F.lit(2.0))),
        "__places": F.transform("__chars", lambda c: F.instr(F.col("__alphabet"), c).cast("double"))})
    step3 = step2.withColumns({
        "__mean": F.aggregate("__places", F.lit(0.0), lambda acc, x: acc + x) / F.col("__n"),
        "__kinds": F.when(mixed, F.transform("__chars", class_of)).otherwise(
            F.transform("__places", lambda x: (x * 2 > F.col("__k")).cast("int")))})
    # neighbours: the array against itself moved by one (the last pair has a null and counts for nothing)
    step4 = step3.withColumns({
        "__changes": F.size(F.filter(F.zip_with("__kinds", F.slice("__kinds", 2, F.size("__kinds")), lambda x, y: x != y), lambda d: d)).cast("double"),
        "__spread": F.aggregate("__places", F.lit(0.0), lambda acc, x: acc + F.pow(x - F.col("__mean"), F.lit(2.0))),
        "__lag": F.aggregate(F.zip_with("__places", F.slice("__places", 2, F.size("__places")),
                                        lambda x, y: F.coalesce((x - F.col("__mean")) * (y - F.col("__mean")), F.lit(0.0))),
                             F.lit(0.0), lambda acc, x: acc + x)})
    n, k = F.col("__n"), F.col("__k")
    chi = F.col("__squares") * k / n - n
    excess = (n - 1) * F.greatest(k * F.col("__agree") - 1, F.lit(0.0))  # ordinary text: non-central chi-squared
    other = 1 - F.col("__same")
    return step4.withColumns({
        "z_chi": (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n),
        "z_plain": ((k - 1) + excess - chi) / F.sqrt(2 * (k - 1) + 4 * excess),
        "z_runs": (F.col("__changes") - (n - 1) * other) / F.sqrt((n - 1) * other * F.col("__same")),
        "z_changes": (F.col("__changes") - (n - 1) * ORDINARY_CHANGES) / F.sqrt((n - 1) * ORDINARY_CHANGES * (1 - ORDINARY_CHANGES)),
        "z_serial": F.when(F.col("__spread") > 0, (F.col("__lag") / F.col("__spread") + 1 / n) * F.sqrt(n)).otherwise(99.0),
    }).withColumn("z_ordinary", F.when(mixed, (F.col("z_plain") + F.col("z_changes")) / F.sqrt(F.lit(2.0))).otherwise(F.col("z_plain")))


def discovery_limits(scored: DataFrame, rate: float) -> dict[tuple[str, int], int]:
    """Benjamini-Hochberg per (encoding, length class): the least passing bin of ``-10 log10 p``.

    One row per class comes to the driver: 8 encodings times the logarithm of the longest token.
    """
    counts = scored.groupBy("__enc", "__class", "__bin").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("__ok").cast("long")).alias("r"))
    above = Window.partitionBy("__enc", "__class").orderBy(F.desc("__bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy("__enc", "__class")
    passing = (counts.withColumns({"found": F.sum("r").over(above), "all": F.sum("m").over(every)})
               .where((F.col("found") > 0) & (F.pow(F.lit(10.0), -F.col("__bin") / 10) * F.col("all") <= rate * F.col("found"))))
    return {(r[0], r[1]): r[2] for r in passing.groupBy("__enc", "__class").agg(F.min("__bin")).collect()}


def clear_tokens(found: DataFrame) -> DataFrame:
    """(``__row``, ``__start``, ``__end``, ``__token``) of the tokens that no base span of their text overlaps.

    In a text with base spans, both are put in order: a token is clear if the furthest end before it and the
    nearest start after it lie outside.  That takes sorting, not a look at every pair.
    """
    columns = ["__row", F.col("__e.start").alias("__start"), F.col("__e.end").alias("__end"), F.col("__e.token").alias("__token")]
    alone = found.where(F.size("__base") == 0).select("__row", F.explode("__found").alias("__e")).select(*columns)
    spans = F.transform("__base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.lit(None).cast("string").alias("token")))
    events = (found.where(F.size("__base") > 0).select("__row", F.explode(F.concat(spans, F.col("__found"))).alias("__e")).select(*columns))
    is_base = F.col("__token").isNull()
    before = Window.partitionBy("__row").orderBy("__start").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("__row").orderBy(F.desc("__start")).rowsBetween(Window.unboundedPreceding, 0)
    placed = events.withColumns({"__past": F.max(F.when(is_base, F.col("__end"))).over(before),
                                 "__next": F.min(F.when(is_base, F.col("__start"))).over(after)})
    outside = F.coalesce(F.col("__past") <= F.col("__start"), F.lit(True)) & F.coalesce(F.col("__next") >= F.col("__end"), F.lit(True))
    return alone.unionByName(placed.where(~is_base & outside).drop("__past", "__next"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_token: int = 20,
                 rate: float = 0.01) -> DataFrame:
    """One row per document: id, ``base`` and ``spans``: arrays of (start, kind_no, end, kind) in order."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*[_spans(F.col("__t"), *p) for p in PATTERNS])
    token = _spans(F.col("__t"), RANDOM, TOKEN, 0, min_token, TOKEN[:-1] + f"{{{min_token}}}", with_text=True)
    # one pass over the texts; only spans and candidate tokens are written
    found = cut(docs.select(F.col(id_col).alias("__id"), text.alias("__t")).withColumns({"__base": base, "__found": token})
                .select("__id", F.monotonically_increasing_id().alias("__row"), "__base", "__found"), "found")
    tokens = clear_tokens(found.where(F.size("__found") > 0))
    tested = battery(tokens)
    p = normal_tail(F.col("z_ordinary"))
    random = (F.col("z_chi") <= VETO) & (F.abs(F.col("z_runs")) <= VETO) & (F.abs(F.col("z_serial")) <= VETO)
    scored = cut(tested.select("__row", "__start", "__end", "__enc", F.floor(F.log2("__n")).cast("int").alias("__class"),
                               F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-300)))).cast("int").alias("__bin"),
                               random.alias("__ok")), "scored")
    limits = discovery_limits(scored, rate)
    limit = F.lit(None).cast("int")
    if limits:
        limit = F.element_at(F.create_map(*[F.lit(x) for (e, c), b in sorted(limits.items()) for x in (f"{e}/{c}", b)]),
                             F.concat_ws("/", "__enc", F.col("__class").cast("string")))
    kinds = [k for k, *_ in PATTERNS] + [RANDOM]
    number = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    ordered = lambda arr: F.array_sort(F.transform(arr, lambda s: F.struct(
        s["start"].alias("start"), F.element_at(number, s["kind"]).alias("kind_no"), s["end"].alias("end"), s["kind"].alias("kind"))))
    added = (scored.where("__ok").where(F.col("__bin") >= limit).groupBy(F.col("__row").alias("__r"))
             .agg(F.collect_list(F.struct(F.col("__start").alias("start"), F.col("__end").alias("end"), F.lit(RANDOM).alias("kind"))).alias("__more")))
    return (found.join(added, F.col("__row") == F.col("__r"), "left")
            .select(F.col("__id").alias(id_col), ordered(F.col("__base")).alias("base"),
                    ordered(F.concat("__base", F.coalesce("__more", F.expr("cast(array() as array<struct<start:int,end:int,kind:string>>)")))).alias("spans")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

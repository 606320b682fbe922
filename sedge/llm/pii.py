"""Personal data by boosted trees over candidate spans, in DataFrame operations alone.

Per kind, a strict pattern with its checks gives the base spans.  High-recall generators propose
candidates besides: every base-shaped match whether or not it passes its check, every run of digits as
each numeric kind, card-sized groups of digits within longer runs, and addresses with other letters or
with their signs spelt out, so proposals overlap.  Boosted trees, one model a kind, score a candidate by
its format and context; a calibrated threshold selects, and selected candidates that touch no base span
are added to the base, the first of those that overlap.

The trees learn from the candidates of a bounded sample of documents (``sample_docs``, by a hash of their
text, copies once), of which about ``sample`` are drawn by a hash, half of them base spans, which are
positive, half of them candidates that touch none and so could be added: these are positive by
``plausible``, a check that doesn't depend on the base patterns.  Other candidates are left out.  Half of
the sample fits the trees, the other half sets the threshold, the lowest score from which on at least
``precision`` of that half's candidates that could be added are positive.  On the main path the trees
are nested CASE expressions inside array functions; no row leaves the JVM and nothing is shuffled.  Places
are running sums, taken block by block, and overlaps are found by halving sorted places, so that a text
with very many matches costs little more than in proportion.

Defined cases: a null text counts as empty; a null id is passed through; repeated rows give repeated
results; without candidates nothing is learnt or added; an empty table gives an empty result; other
columns are left out of the scan, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import new_folder, removed, written

KINDS = ["email", "ip", "card", "phone"]
#: The base patterns, with possessive quantifiers where a match can't be shorter.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
DIGITS = r"[(0-9](?:(?<=[0-9])|(?<=\()(?=[0-9]{1,5}\))[0-9])(?:[\x20().-]{0,2}+[0-9]){6,24}+"
CARDS = r"[0-9](?<![0-9][0-9])(?:[0-9]{13,18}+|[0-9]{3}(?:[\x20.-][0-9]{4}){3}|[0-9]{3}[\x20.-][0-9]{6}[\x20.-][0-9]{4,5}+)(?![0-9])"
_WORD, _OPEN, _SHUT = r"[\p{L}\p{N}-]{1,63}+", r"\x20?[(\[{<]\x20?", r"\x20?[)\]}>]\x20?"
_DOT = rf"(?:\.|{_OPEN}(?i:dot|\.){_SHUT}|\x20(?i:dot|\.)\x20)"
MAIL = rf"(?<![\p{{L}}\p{{N}}._%+-])[\p{{L}}\p{{N}}._%+-]{{1,64}}+(?:(?:\x20?@\x20?|{_OPEN}(?i:at|@){_SHUT}){_WORD}(?:{_DOT}{_WORD}){{1,5}}|\x20(?i:at)\x20{_WORD}(?:\x20(?i:dot)\x20{_WORD}){{1,5}})"
AT = r"[(\[{<]\x20?(?i:at)\x20?[)\]}>]"
TOP = r"(?i)[^\p{L}](?:[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|app|dev|[\p{L}&&[^a-z]]{2,24})$"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = 24
BLOCK = 256
FEATURES = ["kind", "n_chars", "n_digits", "n_groups", "dots", "dashes", "spaces", "plus_before", "bracket", "luhn", "octets", "word_before", "word_after", "digit_after", "names_phone", "names_card", "names_ip", "names_mail", "joined_before", "card_groups", "top", "bare"]
#: Generators by name; the four base patterns propose for their kind, with the base check.
GENERATORS = PATTERNS | {"digits": DIGITS, "cards": CARDS, "mail": MAIL}
INTS = "array<int>"


def _gate(name: str, text: Column) -> Column:
    """A cheap test that every text with a match passes."""
    tests = {"email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "phone": text.rlike(r"\+[0-9]"), "cards": text.rlike("[0-9]{4}"), "mail": spells_mail(text)}
    return tests.get(name, text.rlike("[0-9]"))


def _running(lengths: str) -> Column:
    """Running sums of an array column, in blocks, as a single fold would copy all it has for each element."""
    n = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
        lambda k: F.aggregate(F.slice(F.col(lengths), k * BLOCK + 1, F.lit(BLOCK)), F.array().cast(INTS), lambda acc, x: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0)) + x)),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(INTS).alias("out"))
    joined = lambda acc, b: F.struct((acc["at"] + F.get(b, F.size(b) - 1)).alias("at"), F.concat(acc["out"], F.transform(b, lambda x: x + acc["at"])).alias("out"))
    return F.when(n > 0, F.aggregate(blocks, start, joined, lambda acc: acc["out"]))


def _below(sorted_: str, value: Column) -> Column:
    """How many elements of a sorted array column are smaller."""

    def step(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"], 1)
        half = F.when(F.get(F.col(sorted_), mid) < value, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))
        return F.when(acc["lo"] >= acc["hi"], acc).otherwise(half)

    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), F.struct(F.lit(0).alias("lo"), F.size(sorted_).alias("hi")), step, lambda acc: acc["lo"])


def _placed(pairs: Column, ends: Column) -> Column:
    """Matches with their places and context, from (gap, match) pairs and the running sums of their lengths."""
    of = lambda i, field: F.coalesce(F.get(pairs, i)[field], F.lit(""))

    def match(x, i):
        before = F.right(F.concat(of(i - 1, "m"), x["gap"]), F.lit(CONTEXT))
        after = F.left(F.concat(of(i + 1, "gap"), of(i + 1, "m")), F.lit(2))
        end = F.get(ends, i)
        return F.struct((end - F.char_length(x["m"])).alias("start"), end.alias("end"), x["m"].alias("m"), before.alias("before"), after.alias("after"))

    return F.when((F.size(pairs) > 1) & (F.size(ends) > 1), F.filter(F.transform(pairs, match), lambda x: x["m"].isNotNull()))


def with_matches(df: DataFrame, text: Column) -> DataFrame:
    """Adds a column __m_name of each generator's matches: array<struct<start, end, m, before, after>>, in
    code points from 0, with the ``CONTEXT`` characters before (from the previous match on) and two after.

    Each step is a projection of its own whose columns the next one uses more than once: so Spark keeps them
    apart, and no lambda evaluates an array again for each of its elements.
    """
    made = []
    for name, pattern in GENERATORS.items():
        gate = _gate(name, text)
        pair = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), lambda m, gap: F.struct(gap.alias("gap"), m.alias("m")))
        df = df.withColumn(f"__p_{name}", F.when(gate, pair))
        made.append(f"__p_{name}")
    for name in GENERATORS:
        df = df.withColumn(f"__l_{name}", F.transform(f"__p_{name}", lambda p: F.char_length(p["gap"]) + F.coalesce(F.char_length(p["m"]), F.lit(0))))
        made.append(f"__l_{name}")
    for name in GENERATORS:
        df = df.withColumn(f"__e_{name}", _running(f"__l_{name}"))
        made.append(f"__e_{name}")
    for name in GENERATORS:
        df = df.withColumn(f"__m_{name}", _placed(F.col(f"__p_{name}"), F.col(f"__e_{name}")))
    return df.drop(*made)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def valid(kind: str, m: Column) -> Column:
    """The base check of a match."""
    n = F.length(digits_of(m))
    return {"email": F.lit(True), "ip": m.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"), "card": n.between(14, 19) & F.coalesce(F.call_function("luhn_check", digits_of(m)), F.lit(False)), "phone": n.between(10, 15)}[kind]


def plausible(c: Column) -> Column:
    """Whether a described candidate is personal data by format and context, whatever the base patterns say."""
    x = lambda name: c[f"x{FEATURES.index(name)}"]
    is_ = lambda name: x(name) == 1
    n, apart = x("n_digits"), ~is_("joined_before") & ~is_("word_after") & ~is_("digit_after")
    card = apart & is_("luhn") & is_("card_groups") & n.between(14, 19)
    phone = apart & ~card & is_("names_phone") & n.between(10, 15)
    checks = [is_("top") & (~is_("bare") | is_("names_mail")), apart & is_("octets") & is_("names_ip"), card, phone]
    return F.element_at(F.array(*checks), x("kind").cast("int") + 1)


def spells_mail(text: Column) -> Column:
    """A cheap test that every text with a match of ``MAIL`` passes."""
    return text.contains("@") | text.rlike(r"\x20(?i:dot)\x20") | text.rlike(AT)


def proposes(text: Column) -> Column:
    """Whether a text can have candidates at all."""
    return text.rlike("[0-9]") | spells_mail(text)


def candidates() -> Column:
    """array<struct<start, end, kind, m, before, after, base>> of all proposals, from ``with_matches``'s columns."""

    def proposed(name: str, kinds: list[int], checked: bool) -> Column:
        own = lambda s, k: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind"), s["m"].alias("m"), s["before"].alias("before"), s["after"].alias("after"), (valid(KINDS[k], s["m"]) if checked else F.lit(False)).alias("base"))
        found = F.flatten(F.transform(f"__m_{name}", lambda s: F.array(*[own(s, k) for k in kinds])))
        return F.coalesce(found, F.array().cast("array<struct<start:int,end:int,kind:int,m:string,before:string,after:string,base:boolean>>"))

    parts = [proposed(kind, [k], True) for k, kind in enumerate(KINDS)]
    parts += [proposed("digits", [1, 2, 3], False), proposed("cards", [2], False), proposed("mail", [0], False)]
    return F.concat(*parts)


def described(c: Column) -> Column:
    """A candidate with its features as doubles, in the order of ``FEATURES``."""
    m, before, after = c["m"], F.lower(c["before"]), c["after"]
    groups = F.trim(F.regexp_replace(m, "[^0-9]+", " "))
    count = lambda chars: F.length(m) - F.length(F.translate(m, chars, ""))
    values = [
        c["kind"],
        F.char_length(m),
        F.length(digits_of(m)),
        F.size(F.split(groups, " ")),
        count("."),
        count("-"),
        count(" "),
        F.substring(m, 1, 1) == "+",
        count("()"),
        F.coalesce(F.call_function("luhn_check", digits_of(m)), F.lit(False)),
        groups.rlike(rf"^{OCTET} {OCTET} {OCTET} {OCTET}$"),
        before.rlike(r"[\p{L}\p{N}_=\"'.+-]$"),
        after.rlike(r"^[\p{L}_]"),
        after.rlike(r"^[.-]?[0-9]"),
        before.rlike(r"\b(?:tel|phone|call|mobile|fax|contact)\b"),
        before.rlike(r"\b(?:card|visa|credit|payment|account)\b"),
        before.rlike(r"\b(?:ip|host|address|server)\b"),
        before.rlike(r"\b(?:e-?mail|contact|mail)\b"),
        before.rlike(r"[\p{L}\p{N}]$"),
        groups.rlike("^(?:[0-9]{14,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{2,4}(?: [0-9]{1,3})?|[0-9]{4} [0-9]{6} [0-9]{4,5})$"),
        m.rlike(TOP),
        m.rlike(r"\x20@|@\x20|\x20(?i:at)\x20") & ~m.rlike(rf"{_OPEN}(?i:at|@){_SHUT}"),
    ]
    return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base"), *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(f"x{i}") for i, v in enumerate(values)])


# --- trees ----------------------------------------------------------------------------------------


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, ridge: float = 1.0):
    """A tree as nested (feature, cut, below, above) or a leaf's step."""
    leaf = float(-g.sum() / (h.sum() + ridge))
    if depth == 0 or len(g) < 20:
        return leaf
    best = (1e-6, None)
    for j in range(x.shape[1]):
        values = np.unique(x[:, j])
        if len(values) < 2:
            continue
        cuts = values[1:] if len(values) <= 32 else np.unique(np.quantile(values, np.arange(1, 32) / 32, method="higher"))
        b = np.searchsorted(cuts, x[:, j], side="right")
        gs, hs = np.cumsum(np.bincount(b, g, len(cuts) + 1))[:-1], np.cumsum(np.bincount(b, h, len(cuts) + 1))[:-1]
        gain = gs**2 / (hs + ridge) + (g.sum() - gs) ** 2 / (h.sum() - hs + ridge) - g.sum() ** 2 / (h.sum() + ridge)
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), (j, float(cuts[k])))
    if best[1] is None:
        return leaf
    j, cut = best[1]
    low = x[:, j] < cut
    return (j, cut, grow(x[low], g[low], h[low], depth - 1, ridge), grow(x[~low], g[~low], h[~low], depth - 1, ridge))


def apply(tree, x: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(x), tree)
    j, cut, below, above = tree
    return np.where(x[:, j] < cut, apply(below, x), apply(above, x))


def as_column(tree, of) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    j, cut, below, above = tree
    return F.when(of(j) < cut, as_column(below, of)).otherwise(as_column(above, of))


class Model:
    """Boosted trees and the threshold that selects; without trees nothing is selected."""

    def __init__(self, trees: list, intercept: float = 0.0, threshold: float = float("inf")):
        self.trees, self.intercept, self.threshold = trees, intercept, threshold

    def selects(self, c: Column) -> Column:
        if not self.trees or not np.isfinite(self.threshold):
            return F.lit(False)
        z = F.lit(self.intercept)
        for t in self.trees:
            z = z + as_column(t, lambda j: c[f"x{j}"])
        return z >= self.threshold


class Models:
    """A model for each kind."""

    def __init__(self, models: list[Model]):
        self.models, self.trees = models, [t for m in models for t in m.trees]

    def selects(self, c: Column) -> Column:
        chosen = F.lit(False)
        for k, m in enumerate(self.models):
            chosen = F.when(c["kind"] == k, m.selects(c)).otherwise(chosen)
        return chosen


def fit_rows(x: np.ndarray, y: np.ndarray, new: np.ndarray, rounds: int = 12, depth: int = 3, rate: float = 0.4, precision: float = 0.995) -> Model:
    """Trees from the even rows, the threshold from the odd ones that could be added (``new``)."""
    fit, held = np.arange(len(y)) % 2 == 0, (np.arange(len(y)) % 2 == 1) & new
    if not y[held].any() or not y[fit].any():
        return Model([])
    if y[fit].all() and y[held].all():  # no proposal of this kind is a wrong one
        return Model([0.0], 0.0, 0.0)
    if y[fit].all():
        return Model([])
    share = y[fit].mean()
    model = Model([], float(np.log(share / (1 - share))))
    z = np.full(len(y), model.intercept)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z[fit]))
        tree = _scaled(grow(x[fit], p - y[fit], np.maximum(p * (1 - p), 1e-6), depth), rate)
        model.trees.append(tree)
        z += apply(tree, x)
    order = np.argsort(-z[held], kind="stable")
    s, hit = z[held][order], np.cumsum(y[held][order])
    last = np.flatnonzero(np.append(s[1:] != s[:-1], True))  # equal scores are selected together
    good = last[hit[last] >= precision * (last + 1)]
    model.threshold = float(s[good[-1]]) if len(good) else float("inf")
    return model


def _scaled(tree, rate: float):
    return tree * rate if isinstance(tree, float) else (*tree[:2], _scaled(tree[2], rate), _scaled(tree[3], rate))


def with_candidates(df: DataFrame, text: Column) -> DataFrame:
    """Adds __all, every proposal with its features, __base, the base spans, and their sorted __starts and __ends."""
    df = with_matches(df, text)
    df = df.withColumn("__all", F.transform(candidates(), described)).drop(*[f"__m_{name}" for name in GENERATORS])
    df = df.withColumn("__base", F.filter("__all", lambda c: c["base"]))
    return df.withColumn("__starts", F.array_sort(F.transform("__base", lambda b: b["start"]))).withColumn("__ends", F.array_sort(F.transform("__base", lambda b: b["end"])))


def _apart(c: Column) -> Column:
    """Whether a proposal touches no base span: all that begin before its end have ended by its start."""
    return _below("__starts", c["end"]) == _below("__ends", c["start"] + 1)


def fit_pii(df: DataFrame, sample: int = 10_000, sample_docs: int = 50_000, text_col: str = "text") -> Models:
    """The models learnt from about ``sample`` candidates of at most about ``sample_docs`` documents."""
    spark, text = df.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    folder = new_folder(spark, "pii")
    part = 1 << 30
    share = min(1.0, sample_docs / max(1, df.count()))
    rows = df.select(text.alias("text"), F.xxhash64(text).alias("hash")).where(proposes(F.col("text")) & (F.pmod("hash", F.lit(part)) < int(share * part)))
    rows = with_candidates(rows.dropDuplicates(["hash"]), F.col("text"))

    # outer: a plain explode infers a filter below, which evaluates the candidates again for every element
    found = rows.select("hash", "__starts", "__ends", F.explode_outer("__all").alias("c")).where("c is not null").where(F.col("c.base") | _apart(F.col("c")))
    found = found.select("c", F.when(F.col("c.base"), True).otherwise(plausible(F.col("c"))).alias("y"), F.pmod(F.xxhash64("hash", "c.start", "c.end", "c.kind"), F.lit(part)).alias("h"))
    found = written(found, f"{folder}/candidates")
    counts = {r.base: r.n for r in found.groupBy(F.col("c.base").alias("base")).agg(F.count("*").alias("n")).collect()}
    drawn = F.lit(False)
    for base, n in counts.items():
        drawn = drawn | (F.col("c.base") == base) & (F.col("h") < int(min(1.0, sample / 2 / n) * part))
    # about ``sample`` rows of some 25 numbers, whatever the size of the table
    got = sorted(found.where(drawn).select("c.*", "y", "h").collect(), key=lambda r: (not r.base, r.h, r.start, r.end, r.kind))
    removed(folder)
    x = np.array([[r[f"x{i}"] for i in range(len(FEATURES))] for r in got], np.float64).reshape(len(got), len(FEATURES))
    y, new = np.array([r.y for r in got], np.float64), np.array([not r.base for r in got], bool)
    return Models([fit_rows(x[of], y[of], new[of]) for of in (x[:, 0] == k for k in range(len(KINDS)))])


SPANS = "array<struct<start:int,kind:int,end:int,base:boolean>>"


def with_spans(df: DataFrame, text: Column, model: Models) -> DataFrame:
    """Adds __spans, array<struct<start, kind, end, base>>: base spans and those the model adds, in order.

    Proposals and base spans are columns of their own, so that a lambda never evaluates them again.
    """
    df = with_candidates(df, text)
    short = lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["base"].alias("base"))
    found = F.transform("__base", short)
    if model.trees:
        more = F.array_sort(F.transform(F.filter("__all", lambda c: ~c["base"] & model.selects(c) & _apart(c)), short))
        first = lambda acc, c: F.when((F.size(acc) == 0) | (c["start"] >= F.get(acc, F.size(acc) - 1)["end"]), F.array_append(acc, c)).otherwise(acc)
        found = F.concat(found, F.aggregate(more, F.array().cast(SPANS), first))
    return df.withColumn("__spans", F.array_sort(found)).drop("__all", "__base", "__starts", "__ends")


def find(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array<struct<start, kind, end, base>>) of every row."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return with_spans(rows, F.col("text"), model).select("doc_id", F.coalesce("__spans", F.array().cast(SPANS)).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """The counts and strings of ``find``'s rows."""
    names = F.array(*map(F.lit, KINDS))
    told = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.size("spans").cast("long").alias("n_spans"), F.sha2(F.encode(told(base), "UTF-8"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(df: DataFrame, model: Models, text_col: str = "text") -> DataFrame:
    """All rows and columns, with every span replaced by its kind in brackets (null texts stay null).

    A span that begins within another one goes with it.  Columns keep their names, order and types,
    whatever they are called.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(f"`{text_col}`").alias("__text"))
    marked = with_spans(packed, F.coalesce("__text", F.lit("")), model)
    text, size, last = F.col("__text"), 1024, lambda acc: F.get(acc, F.size(acc) - 1)

    def united(acc, s):
        own = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), F.greatest(last(acc)["end"], s["end"]).alias("end"), s["base"].alias("base"))
        own = F.when(s["start"] < last(acc)["end"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(own.withField("start", last(acc)["start"]).withField("kind", last(acc)["kind"]))))
        return F.coalesce(own, F.array_append(acc, s)).cast(SPANS)

    overlap = F.exists(F.transform("__spans", lambda s, i: s["start"] < F.coalesce(F.get("__spans", i - 1)["end"], F.lit(0))), lambda x: x)
    marked = marked.withColumn("__spans", F.when(overlap, F.aggregate("__spans", F.array().cast(SPANS), united)).otherwise(F.col("__spans")))
    # a text is cut into blocks once, so that a piece of it is looked for in one or two of them
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.char_length(text) / size).cast("int")), lambda k: F.substring(text, k * size + 1, F.lit(size)))
    marked = marked.withColumn("__blocks", F.when(F.size("__spans") > 0, blocks))

    def piece(start: Column, end: Column) -> Column:
        k = F.floor(start / size).cast("int")
        near = F.concat(F.get("__blocks", k), F.coalesce(F.get("__blocks", k + 1), F.lit("")))
        return F.when(end <= (k + 2) * size, F.substring(near, start - k * size + 1, end - start)).otherwise(F.substring(text, start + 1, end - start))

    ended = lambda i: F.coalesce(F.get("__spans", i)["end"], F.lit(0))
    parts = F.transform("__spans", lambda s, i: F.concat(piece(ended(i - 1), s["start"]), F.get(names, s["kind"])))
    tail = F.substring(text, ended(F.size("__spans") - 1) + 1, F.char_length(text))
    done = F.when(F.size("__spans") > 0, F.concat(F.array_join(parts, ""), tail)).otherwise(text)
    return marked.select(*[done.alias(c) if c == text_col else F.col("__row").getField(c).alias(c) for c in df.columns])

"""Secret scanning with fixed patterns and character Markov models, in DataFrame expressions only.

Patterns find assignments, access keys and long hex strings. Beyond them, every long run of
identifier characters is scored by two first-order character models, one of random strings
and one of ordinary identifiers: a run whose log-likelihood ratio is high enough is a secret
of kind ``markov``. The models are trained from all texts: what the patterns match there are the
random strings, words of the rest, and a short list of words that names are made of, are the
ordinary ones.

An ordinary identifier is a row of parts, so the ordinary model reads a run part by part: a change
of case, a separator, and the places where letters and digits meet begin a part; letters follow
each other as in the training words, which also say how readily a word ends after a letter.
Numbers are digit groups, which may be joined by separators (dates). A group of up to four
characters repeated four times or more counts once, and so does the alphabet, so drawn rules are
short; UUIDs are left out. A random string is either like the trained ones, or even over the kinds of characters it has,
whichever is likelier. The least ratio per character is set on different words kept out of training: those
joined to names in the usual ways must stay below it, but for a small share.

Positions without a function that returns them: matches are put between marks, the text is
split at the marks, and the lengths of the pieces add up to code-point positions. A mark
that occurs in a text is replaced first by another character, which no pattern matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

MARK, OTHER_MARK = "\x01", "\x02"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Kinds in the order of listing: (name, pattern that marks matches, least length of what counts, its group).
#: The marking patterns find just the matches that are long enough, where that is the same.
BASE = (("assign", ASSIGN), ("access", r"AKIA[A-Z0-9]{16,}"), ("hex", r"[0-9a-f]{24,}"))
ASSIGN_VALUE_CHARS = 6
KINDS = ("assign", "access", "hex", "markov")

#: Characters of a run, and the least length that is scored.
RUN_CLASS, RUN_CHARS = "[A-Za-z0-9+/_-]", 16
RUN = RUN_CLASS + "{%d,}" % RUN_CHARS
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
#: One in HELD_OUT of the texts' different words is kept for the least ratio per character; that is ``LEAST_PER_CHAR`` or more, and so that
#: ``NAMES_BELOW`` of the names made of the kept words stay below it. The whole ratio is ``LEAST_RATIO`` at least.
HELD_OUT, LEAST_PER_CHAR, NAMES_BELOW, LEAST_RATIO = 4, 1.3, 0.995, 9.0
#: Kept words that are made into names together, and the steps of one that the ratio per character is counted in.
GROUP_WORDS, RATIO_STEPS = 300, 1_000
#: Characters that must be left of a run when what repeats is shortened, and how often a listed word counts.
LEAST_CHARS, LISTED_WEIGHT = 8, 8
#: Share of the texts' different long numbers that makes a shape an ordinary one.
NUMBER_SHARE = 0.01
#: Pseudo-counts: random strings are uniform over letters and digits, words over letters, until the texts say otherwise.
RANDOM_PRIOR, PAIR_PRIOR, SINGLE_PRIOR, END_PRIOR = 10.0, 5.0, 0.5, 4.0
#: Symbols of the ordinary model: letters (whatever their case), 0 for any digit, ^ for a change of case, : for a separator
#: between digits, the separators, and the end of the run.
ORDINARY = "abcdefghijklmnopqrstuvwxyz0^:_-/+$"
_SEPARATORS = "_-/+"
#: What follows a part of letters, and a digit; what a run or a part after a separator begins with. Shares of one.
_AFTER_WORD = {"$": 0.4, "^": 0.25, "_": 0.1, "-": 0.1, "/": 0.1, "+": 0.01, "0": 0.04}
_AFTER_DIGIT = {"0": 0.2, ":": 0.3, "$": 0.2, "letter": 0.18, "_": 0.03, "-": 0.03, "/": 0.03, "+": 0.01}
_AFTER_SEPARATOR = {"letter": 0.8, "0": 0.1, "$": 0.02, "_": 0.02, "-": 0.02, "/": 0.02, "+": 0.02}
UUID = "[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}"
#: Words that identifiers, paths and slugs are often made of; samples of ordinary parts beside the texts' words.
ORDINARY_WORDS = """access account action address after agent alert apply archive argument array article async attribute author
 backup balance base batch before binary block body bool branch bucket buffer build button byte cache call cancel category change channel
 check child class clean client clock close cloud cluster code color column command comment common company compare complete component
 config connect constant container content context control convert count country create current custom customer data date day debug
 default delete device dialog directory display document domain download drive edit element email empty enable encode engine entity entry
 environment error event example execute export extra factory failure feature field file filter final find first flag folder format frame
 function general generate global graph group handle handler header height history home host icon image import index info initialize
 inner input insert instance integer internal invoice item iterator job journal key label language last layer layout level library limit
 line link list load local location lock logger long main manager map master max memory menu message method model module month mouse name
 network node null number object offset open option order output package page panel parameter parent parse password path pattern payment"""
#: Pieces whose lengths are added up at a time.
PIECES = 128


def _clean(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.when(F.instr(text, MARK) > 0, F.translate(text, MARK, OTHER_MARK)).otherwise(text)


def _pieces(text: Column, pattern: str) -> Column:
    """Text outside and inside matches in turn; empty where nothing matches."""
    marked = F.regexp_replace(text, pattern, f"{MARK}$0{MARK}")
    return F.when(text.rlike(pattern), F.split(marked, MARK, -1)).otherwise(F.array().cast("array<string>"))


def _fixed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once a row, however often later expressions name them.

    The generator is a border that projections aren't merged across; without it an expression
    inside a lambda would be worked out again for each element.
    """
    packed = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("__fixed"))
    return packed.select(*df.columns, *[F.col(f"__fixed.{n}").alias(n) for n in columns])


def _hits(df: DataFrame, pieces: str, hits: str, counts, kind: int) -> DataFrame:
    """Add ``hits``: structs (start, kind, end) of the matches in column ``pieces`` for which ``counts(match)`` holds.

    Lengths are added up in two levels, so the work is nearly in proportion to the pieces.
    """
    blocks = F.when(F.size(pieces) > 0, F.sequence(F.lit(0), F.floor((F.size(pieces) - 1) / PIECES).cast("int"))) \
        .otherwise(F.array().cast("array<int>"))
    df = _fixed(df, __len=F.transform(pieces, F.length), __blocks=blocks)
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    df = _fixed(df, __sums=F.transform("__blocks", lambda b: total(F.slice("__len", b * PIECES + 1, PIECES))))
    df = _fixed(df, __before=F.transform("__blocks", lambda b: F.when(b > 0, total(F.slice("__sums", 1, b))).otherwise(0)))
    place = F.transform(F.arrays_zip(F.col(pieces).alias("piece"), F.col("__len").alias("n")), lambda x, i: F.struct(
        i.alias("i"), x["piece"].alias("piece"), x["n"].alias("n")))
    odd = F.filter(place, lambda x: (x["i"] % 2 == 1) & counts(x["piece"]))

    def span(x: Column) -> Column:
        block = F.floor(x["i"] / PIECES).cast("int")
        start = F.get("__before", block) + F.when(x["i"] % PIECES > 0, total(
            F.slice("__len", block * PIECES + 1, x["i"] % PIECES))).otherwise(0)
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["n"]).alias("end"))

    df = _fixed(df, **{hits: F.transform(odd, span)})
    return df.drop("__len", "__blocks", "__sums", "__before")


def _counts_base(kind: str, piece: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(piece, ASSIGN, 1)) >= ASSIGN_VALUE_CHARS
    return F.lit(True)


# --- models -------------------------------------------------------------------------

@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihoods by (symbol before, symbol), 0 being the start: of random strings over ``ALPHABET``, of ordinary ones over ``ORDINARY``.

    ``least``: the ratio per character from which on a run is random. ``shapes``: digests of the shapes of ordinary long numbers.
    """

    random: tuple[float, ...]
    ordinary: tuple[float, ...]
    least: float
    shapes: tuple[str, ...] = ()


def _codes(run: Column) -> Column:
    return F.transform(F.split(run, ""), lambda c: F.instr(F.lit(ALPHABET), c))


def _runs(text: Column, least: int) -> Column:
    return F.regexp_extract_all(text, F.lit(RUN_CLASS + "{%d,}" % least), F.lit(0))


def _words(text: Column) -> Column:
    """Words of the letters A to Z alone."""
    return F.regexp_extract_all(text, F.lit(r"(?<![\p{L}\p{N}])[A-Za-z]{2,24}(?![\p{L}\p{N}])"), F.lit(0))


def _is_number(run: Column) -> Column:
    return ~run.rlike("[A-Za-z]") & run.rlike("[0-9]")


def _shape(run: Column) -> Column:
    return F.md5(F.regexp_replace(run, "[0-9]", "0"))


def _learn_random(counted: dict[int, int]) -> tuple[float, ...]:
    """Log-likelihoods of random strings' steps; pairs never seen fall back on single characters, and those on an even share."""
    size, alnum = len(ALPHABET) + 1, sum(c.isalnum() for c in ALPHABET)
    even = [0.98 / alnum if c.isalnum() else 0.02 / (size - 1 - alnum) for c in ALPHABET]
    single = [sum(counted.get(a * 100 + b, 0) for a in range(size)) for b in range(1, size)]
    one = [(n + RANDOM_PRIOR * e * alnum) / (sum(single) + RANDOM_PRIOR * alnum) for n, e in zip(single, even)]
    out = [0.0] * (size * size)
    for a in range(size):
        seen = sum(counted.get(a * 100 + b, 0) for b in range(1, size))
        for b in range(1, size):
            out[a * size + b] = math.log((counted.get(a * 100 + b, 0) + RANDOM_PRIOR * alnum * one[b - 1]) / (seen + RANDOM_PRIOR * alnum))
    return tuple(out)


def _learn_ordinary(words: dict[str, int]) -> tuple[float, ...]:
    """Log-likelihoods of identifiers' steps. ``words``: counts of the steps of training words, by two characters; ^ starts, $ ends one."""
    letters = ORDINARY[:26]
    single = {b: sum(words.get(a + b, 0) for a in "^" + letters) + SINGLE_PRIOR for b in letters}
    total = sum(single.values())
    single = {b: n / total for b, n in single.items()}

    def begins(b: str, a: str = "^") -> float:  # share of the letters that follow a, or begin a word
        seen = sum(words.get(a + c, 0) for c in letters)
        return (words.get(a + b, 0) + PAIR_PRIOR * single[b]) / (seen + PAIR_PRIOR)

    def step(a: str, b: str) -> float:
        if a in letters:
            seen = sum(words.get(a + c, 0) for c in letters)
            ends = (words.get(a + "$", 0) + END_PRIOR * 0.2) / (seen + words.get(a + "$", 0) + END_PRIOR)
            return (1 - ends) * begins(b, a) if b in letters else ends * _AFTER_WORD.get(b, 1e-6)
        after = _AFTER_DIGIT if a == "0" else _AFTER_SEPARATOR
        if a in "^:":  # a capital letter, a digit
            after = {"letter": 1.0} if a == "^" else {"0": 1.0}
        share = after.get("letter", 1e-6) * begins(b) if b in letters else after.get(b, 1e-6)
        if not a and b in _SEPARATORS:
            share = 0.05
        return share / 10 if b == "0" else share  # any of ten digits

    size = len(ORDINARY) + 1
    out = [0.0] * (size * size)
    for i, a in enumerate(["", *ORDINARY]):
        for k, b in enumerate(ORDINARY, 1):
            out[i * size + k] = math.log(max(step(a, b), 1e-6))
    return tuple(out)


def _steps_of(words: Column) -> Column:
    """The steps of words, ^ and $ put around each."""
    lower = F.transform(words, lambda w: F.concat(F.lit("^"), F.lower(w), F.lit("$")))
    return F.flatten(F.transform(lower, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 1), lambda i: F.substring(w, i, F.lit(2)))))


def _names(words: Column) -> Column:
    """Names made of each three words in a row, in the ways that identifiers, paths and slugs are."""
    at = F.when(F.size(words) >= 3, F.sequence(F.lit(1), F.size(words) - 2, F.lit(3))).otherwise(F.array().cast("array<int>"))

    def joined(i: Column) -> Column:
        three = F.slice(words, i, 3)
        lower = F.transform(three, F.lower)
        ways = [F.array_join(lower, s) for s in ("_", "-", "/", "")]
        capital = F.transform(lower, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 30)))
        return F.array(*ways, F.upper(ways[0]), F.array_join(capital, ""))
    return F.flatten(F.transform(at, joined))


def _kept(word: Column) -> Column:
    """Whether a word is kept out of training."""
    return F.pmod(F.xxhash64(word, F.lit("kept")), F.lit(HELD_OUT)) == 0


def _training_parts(docs: DataFrame, text_col: str) -> DataFrame:
    """``(kind, part, n)`` of all texts, a row for each different part: what the patterns match, with its count, words and long numbers of the rest."""
    values = F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(1))
    known = F.concat(F.filter(values, lambda v: F.length(v) >= ASSIGN_VALUE_CHARS),
                     *[F.regexp_extract_all("text", F.lit(p), F.lit(0)) for _, p in BASE[1:]])
    rest = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), "|".join(p for _, p in BASE[1:]), " ")
    text = _fixed(docs.select(_clean(F.col(text_col)).alias("text")), known=known, rest=rest)
    parts = F.map_from_arrays(F.array(*map(F.lit, ("known", "word", "number"))), F.array(
        "known", F.array_distinct(_words(F.col("rest"))), F.array_distinct(F.filter(_runs(F.col("rest"), RUN_CHARS), _is_number))))
    each = text.select(F.explode(parts).alias("kind", "parts")).select("kind", F.explode("parts").alias("part"))
    part = F.when(F.col("kind") == "word", F.lower("part")).otherwise(F.col("part"))
    return each.groupBy("kind", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def train_markov(docs: DataFrame, text_col: str = "text") -> MarkovModels:
    """Train from all rows.

    Runs that the fixed patterns match (for assignments, their values) are the random strings, different words of the rest the
    ordinary ones, but for one in ``HELD_OUT``, chosen by a hash of the word: names made of these set the least ratio. Of long
    numbers the shapes are learned. Where the texts hold none of these the priors and the word list hold. The texts are read once,
    their different parts are written; only counts of symbol pairs, shapes and steps of the ratio reach the driver.
    """
    parts = staged(_training_parts(docs, text_col), "secret-training")
    codes = parts.where("kind = 'known'").select("n", F.concat(F.array(F.lit(0)), _codes(F.col("part"))).alias("codes"))
    steps = codes.select("n", F.explode(F.zip_with(
        F.slice("codes", 1, F.size("codes") - 1), F.slice("codes", 2, F.size("codes") - 1),
        lambda a, b: a * 100 + b)).alias("step"))
    random = _learn_random({r.step: r.n for r in steps.groupBy("step").agg(F.sum("n").alias("n")).collect()})
    words = parts.where("kind = 'word'").select(F.col("part").alias("word"), _kept(F.col("part")).alias("kept"))
    listed = docs.sparkSession.range(1).select(F.explode(F.split(F.lit(" ".join(ORDINARY_WORDS.split())), " ")).alias("word"))
    counts = {r.step: r.n for r in words.where(~F.col("kept")).select("word", F.lit(1).alias("n"))
              .unionByName(listed.withColumn("n", F.lit(LISTED_WEIGHT)))
              .select("n", F.explode(_steps_of(F.array("word"))).alias("step"))
              .groupBy("step").agg(F.sum("n").alias("n")).collect()}  # one row for each pair of letters
    numbers = parts.where("kind = 'number'").groupBy(_shape(F.col("part")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    least = NUMBER_SHARE * (numbers.agg(F.sum("n")).first()[0] or 0)
    shapes = tuple(sorted(r.shape for r in numbers.where(F.col("n") >= least).collect()))  # at most 1 / NUMBER_SHARE
    models = MarkovModels(random, _learn_ordinary(counts), LEAST_PER_CHAR, shapes)
    return replace(models, least=max(LEAST_PER_CHAR, _names_ratio(words.where("kept").select("word"), models)))


def _names_ratio(words: DataFrame, models: MarkovModels) -> float:
    """The ratio per character that ``NAMES_BELOW`` of the names made of ``words`` don't exceed, rounded up to a step; 0 without names."""
    groups = max(1, words.count() // GROUP_WORDS)  # a group's size doesn't grow with the words
    drawn = F.xxhash64("word", F.lit("drawn"))
    grouped = words.groupBy(F.pmod(F.xxhash64("word", F.lit("group")), F.lit(groups)).alias("group")) \
        .agg(F.array_sort(F.collect_list(F.struct(drawn.alias("drawn"), "word")))["word"].alias("words"))
    names = grouped.select(F.explode(_names(F.col("words"))).alias("run")).where(F.length("run") >= RUN_CHARS)
    step = F.ceil(log_ratio(F.col("run"), models)["ratio"] / F.length("run") * RATIO_STEPS)
    counted = sorted((r.step, r["count"]) for r in names.groupBy(step.alias("step")).count().collect())  # logarithms are bounded, so steps are few
    names_left = NAMES_BELOW * sum(n for _, n in counted)
    for at, n in counted:
        names_left -= n
        if names_left <= 0:
            return at / RATIO_STEPS
    return 0.0


def _likelihood(codes: Column, table: tuple[float, ...], size: int) -> Column:
    """Sum over the steps of a run, from the start on."""
    values = F.split(F.lit(",".join(f"{x:.6g}" for x in table)), ",").cast("array<double>")
    steps = F.zip_with(F.concat(F.array(F.lit(0)), codes), codes,
                       lambda a, b: F.when(b.isNotNull(), F.get(values, a * size + b)).otherwise(F.lit(0.0)))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x)


def _once(run: Column) -> Column:
    """The run without UUIDs; a group of characters repeated four times or more, and the alphabet, shortened."""
    bare = F.regexp_replace(F.regexp_replace(run, UUID, ""), "(?i)abcdefghijklmnopqrstuvwxyz", "a")
    return F.regexp_replace(bare, r"(.{1,4}?)\1{3,}", "$1")


def _in_parts(run: Column) -> Column:
    """The run as symbols of the ordinary model."""
    parted = F.regexp_replace(run, r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "^")
    return F.lower(F.concat(F.regexp_replace(F.regexp_replace(parted, r"(?<=[0-9])[-_/](?=[0-9])", ":"), "[0-9]", "0"), F.lit("$")))


def log_ratio(run: Column, models: MarkovModels) -> Column:
    """A struct: the log-likelihood ``ratio`` of a run of alphabet characters, random against ordinary, and the ``chars`` it is made of."""
    def compared(once: Column) -> Column:
        ordinary = _likelihood(F.transform(F.split(_in_parts(once), ""), lambda c: F.instr(F.lit(ORDINARY), c)), models.ordinary, len(ORDINARY) + 1)
        trained = _likelihood(_codes(once), models.random, len(ALPHABET) + 1)
        kinds = [(once.rlike(c), n) for c, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10), (r"\+", 1), ("/", 1), ("_", 1), ("-", 1))]
        even = -F.length(once) * F.log(sum((F.when(has, n).otherwise(0) for has, n in kinds), F.lit(0.0)))
        ratio = F.when(F.length(once) > 1, F.greatest(trained, even) - ordinary).otherwise(F.lit(0.0))
        return F.struct(ratio.alias("ratio"), F.length(once).alias("chars"))
    # A lambda's argument is worked out once.
    return F.get(F.transform(F.array(_once(run)), compared), F.lit(0))


def _is_random(run: Column, models: MarkovModels) -> Column:
    base = "|".join([ASSIGN, *(p for _, p in BASE[1:])])
    number = _is_number(run) & _shape(run).isin(*models.shapes) if models.shapes else F.lit(False)
    random = F.exists(F.array(log_ratio(run, models)), lambda r: (
        r["chars"] >= LEAST_CHARS) & (r["ratio"] >= LEAST_RATIO) & (r["ratio"] >= models.least * r["chars"]))
    return ~run.rlike(base) & ~number & random


MARKOV_PIECES = f"{ASSIGN}|{RUN}"


# --- operator -------------------------------------------------------------------------

def find_secrets(docs: DataFrame, models: MarkovModels, text_col: str = "text") -> DataFrame:
    """``docs`` with two more columns, ``base_spans`` and ``spans``: arrays of (start, kind, end) by
    start and kind; kind is a place in ``KINDS``, positions are code points, ends exclusive.

    ``spans`` holds the base spans and those the models add. Null texts are empty; empty texts have
    no spans. Matches of one kind don't overlap, those of different kinds may. Repeated rows give
    equal spans; an empty table gives no rows. Columns of ``docs`` of these names are replaced.
    """
    keep = [c for c in docs.columns if c not in ("base_spans", "spans")]
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"), _clean(F.col(text_col)).alias("__text"))
    df = _fixed(df, **{f"__p{k}": _pieces(F.col("__text"), p) for k, p in enumerate([*(p for _, p in BASE), MARKOV_PIECES])})
    df = df.drop("__text")
    for k, (kind, _) in enumerate(BASE):
        df = _hits(df, f"__p{k}", f"__h{k}", lambda piece, kind=kind: _counts_base(kind, piece), k)
    df = _hits(df, "__p3", "__h3", lambda piece: _is_random(piece, models), 3)
    df = _fixed(df, base_spans=F.array_sort(F.concat("__h0", "__h1", "__h2")))
    return df.select("__row.*", "base_spans", F.array_sort(F.concat("base_spans", "__h3")).alias("spans"))


def equals(value: int):
    """A condition for filter(): the element is ``value``."""
    return lambda x: x == value


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, models: MarkovModels, text_col: str = "text",
                   stand_in: str = "[redacted]") -> DataFrame:
    """``docs`` with every secret in the text replaced, and ``n_chars`` (where there is one) brought up to date.

    Rows, order of columns and null texts stay; a text without secrets stays as it is.
    """
    df = _fixed(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                            F.col(text_col).alias("__text")), __now=_clean(F.col("__text")))
    steps = [(p, lambda piece, kind=kind: _counts_base(kind, piece)) for kind, p in BASE]
    for pattern, counts in [*steps, (MARKOV_PIECES, lambda piece: _is_random(piece, models))]:
        df = _fixed(df, __p=_pieces(F.col("__now"), pattern))
        joined = F.array_join(F.transform("__p", lambda x, i: F.when((i % 2 == 1) & counts(x), F.lit(stand_in)).otherwise(x)), "")
        df = _fixed(df, __next=F.when(F.size("__p") > 0, joined).otherwise(F.col("__now")))
        df = df.select("__row", "__text", F.col("__next").alias("__now"))
    changed = F.col("__text").isNotNull() & (F.col("__now") != _clean(F.col("__text")))
    out = []
    for c in docs.columns:
        old = F.col("__row").getField(c)
        new = F.col("__now") if c == text_col else F.length("__now").cast(docs.schema[c].dataType) if c == "n_chars" else None
        out.append((F.when(changed, new).otherwise(old) if new is not None else old).alias(c))
    return df.select(*out)

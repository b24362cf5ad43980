"""Secrets in text: patterns of known kinds, and stretches of high Shannon entropy. Only built-in functions.

The entropy scan looks at candidate strings, the longest runs of the characters of each class; a hexadecimal run inside
a path is a candidate of its own. A window slides over a candidate by one character a step. The counts of its symbols are kept from step to step: the symbol that enters is added, the
one that leaves is taken away, and the sum of ``c log2 c`` changes by those two terms. The entropy of a window of
``w`` characters is ``log2 w - sum / w``. A candidate is reported from the first to the last window at or above the
limit of its class, unless the allow-list knows that span. Words that say they are examples, and UUIDs, bound
candidates: they don't excuse what is joined to them by a mark. Spans of several classes that overlap are one, and what
spans of known kinds cover is cut out of it.

Positions are code points, ends exclusive. Defined cases: a null or empty text has no spans; rows are never
compared, so null ids, ties and repeated rows need no rule.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import id_text

SPAN = "array<struct<start:int,rank:int,stop:int,kind:string>>"


class Kind(NamedTuple):
    name: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of that group; shorter matches are dropped after matching


# The kinds and their patterns, in the order of the contract. Runs shorter than asked can't hold a
# longer match, so that the last two carry their least length in the pattern.
KINDS = (
    # password, passwd, secret, token, apikey or api_key in either case; by its first letter, which is much faster
    Kind("assign", r"""[pPsStTaA](?i:(?<=p)assw(?:or)?d|(?<=s)ecret|(?<=t)oken|(?<=a)pi_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 8),
    Kind("access", r"AKIA[A-Z0-9]{12,}"),
    Kind("hex", r"[0-9a-f]{32,}"),
)


class CharClass(NamedTuple):
    name: str
    pattern: str
    symbols: str
    window: int
    limit: float  # bits a character


_HEX = "0123456789abcdef"
_WORD = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Candidates are runs bounded by characters out of the class. Every window of a class with a limit at or above that of
#: a class before it needn't be scanned again where no character is new, hence ``_NEW``.
CLASSES = (
    CharClass("hex", r"[0-9a-fA-F]{20,}", _HEX, 20, 3.0),
    CharClass("alnum", r"[0-9A-Za-z]{20,}", _WORD, 20, 3.7),
    CharClass("base64", r"[0-9A-Za-z+/=_-]{20,}", _WORD + "+/=_-", 20, 3.7),
)
_NEW = {"hex": "", "alnum": "[g-zG-Z]", "base64": "[+/=_-]"}
_EXAMPLE = r"(?i:example|sample|dummy|placeholder|abcdefgh|01234567|xxxxxxxx)"
_UUID = r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
#: Strings that are no secrets; no pattern may repeat a group without a bound, which Java's matcher does by recursion: words, names joined by marks, numbers, one case of letters with marks, ordered
#: alphabets, UUIDs and what says that it is an example.
ALLOWED = (
    r"[A-Za-z+/=_-]+",
    r"[0-9+/=_-]+",
    r"[A-Za-z+/=_-]*[0-9]{0,4}",
    f".*{_EXAMPLE}.*",
    _UUID,
)
#: Those whose parts are no secrets either: a candidate of such a kind isn't scanned.
_CLOSED = ALLOWED[:3]


def spans_of(text: Column, pattern: str, whole: Column, rank: int, kind: str, judged: Column | None = None,
             keep=None) -> Column:
    """Spans of the matches ``whole`` of ``pattern`` in ``text``, leftmost and not overlapping: the pieces between
    matches and the matches themselves, taken in turn, add up to the positions. ``keep`` judges ``judged``, a part
    of each match, or the match."""
    none = F.array().cast(SPAN)
    judged = whole if judged is None else judged
    turns = F.arrays_zip(F.split(text, pattern, -1).alias("piece"), whole.alias("whole"), judged.alias("judged"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        stop = start + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), stop.alias("stop"),
                                F.lit(kind).alias("kind")))
        good = x["whole"].isNotNull() if keep is None else x["whole"].isNotNull() & keep(x["judged"])
        return F.struct(stop.alias("at"), F.when(good, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(turns, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(F.size(whole) > 0, found).otherwise(none)


def _parts(whole: Column, kind: Kind) -> Column:
    return F.transform(whole, lambda m: F.regexp_extract(m, kind.pattern, kind.group))


def _weight(count: Column) -> Column:
    """``c log2 c``, 0 for no occurrence."""
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def entropy_range(run: Column, cls: CharClass) -> Column:
    """``struct<first, last>``: where in ``run`` the first window at or above the limit begins and the last one
    ends, from 0; ``first`` is -1 without any. The counts live in an array that changes by two entries a step."""
    n, w = len(cls.symbols), cls.window
    fold = F.lower(run) if cls.name == "hex" else run
    enter = F.transform(F.split(fold, ""), lambda c: F.instr(F.lit(cls.symbols), c))
    leave = F.concat(F.array_repeat(F.lit(0), w), enter)
    turns = F.slice(F.arrays_zip(enter.alias("enter"), leave.alias("leave")), 1, F.length(run))

    def step(acc: Column, x: Column) -> Column:
        gone = F.when(x["leave"] > 0, F.element_at(acc["counts"], F.greatest(x["leave"], F.lit(1)))).otherwise(F.lit(0))
        had = F.element_at(acc["counts"], x["enter"]) - F.when(x["leave"] == x["enter"], 1).otherwise(0)
        total = acc["total"] - _weight(gone) + _weight(gone - 1) + _weight(had + 1) - _weight(had)
        counts = F.transform(acc["counts"], lambda c, k: c + F.when(k + 1 == x["enter"], 1).otherwise(0)
                             - F.when(k + 1 == x["leave"], 1).otherwise(0))
        i = acc["i"] + 1
        high = (i >= w) & (F.log2(F.lit(float(w))) - total / w >= cls.limit)
        return F.struct(i.alias("i"), counts.alias("counts"), total.alias("total"),
                        F.when(high & (acc["first"] < 0), i - w).otherwise(acc["first"]).alias("first"),
                        F.when(high, i).otherwise(acc["last"]).alias("last"))

    start = F.struct(F.lit(0).alias("i"), F.array_repeat(F.lit(0), n).alias("counts"), F.lit(0.0).alias("total"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    return F.aggregate(turns, start, step, lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, spans``; a span is ``start, rank, stop, kind``, in order of start,
    then kind. A text with many matches costs their number squared, as its spans are gathered in one array."""
    rows = id_text(docs, id_col, text_col)
    return with_spans(rows, "text", allowed).select("doc_id", "text", "spans")


def with_spans(rows: DataFrame, text_col: str = "text", allowed: tuple[str, ...] = ALLOWED,
               spans: str = "spans") -> DataFrame:
    """``rows`` with their spans. Every step is a projection of its own, so that no match is computed twice."""
    text, candidates = F.col(text_col), CLASSES[-1].pattern
    rows = rows.withColumns(
        {f"__whole_{k.name}": F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)) for k in KINDS[:2]}
        | {"__runs": F.regexp_extract_all(text, F.lit(candidates), F.lit(0))})
    # A long run of hexadecimal digits lies in a candidate run, so that few texts need this scan.
    rows = rows.withColumn("__whole_hex", F.when(
        F.size("__runs") > 0, F.regexp_extract_all(text, F.lit(KINDS[2].pattern), F.lit(0)))
        .otherwise(F.array().cast("array<string>")))
    base = F.concat(*(
        spans_of(text, k.pattern, F.col(f"__whole_{k.name}"), rank, k.name,
                 _parts(F.col(f"__whole_{k.name}"), k) if k.group else None,
                 (lambda g, k=k: F.length(g) >= k.least) if k.least else None)
        for rank, k in enumerate(KINDS)))
    runs = spans_of(text, candidates, F.col("__runs"), len(KINDS), "entropy")
    closed = tuple(p for p in _CLOSED if p in allowed)
    rows = rows.withColumns({
        "__base": F.array_sort(base),
        "__parts": F.transform(runs, lambda s: F.struct(s["start"].alias("start"), bounded(
            F.substring(text, s["start"] + 1, s["stop"] - s["start"]), allowed).alias("run")))})
    rows = rows.withColumn("__parts", F.filter("__parts", lambda x: x["run"].rlike(candidates)))
    rows = rows.withColumn("__ranges", F.concat(*(
        F.flatten(F.transform("__parts", candidates_of(cls, closed))) for cls in CLASSES)))

    def high(x: Column) -> Column:
        """Where the windows at or above the limit lie in the text, for a candidate ``start, rank, run``."""
        found = F.when(x["rank"] == 0, entropy_range(x["run"], CLASSES[0]))
        for rank, cls in enumerate(CLASSES[1:], 1):
            found = found.when(x["rank"] == rank, entropy_range(x["run"], cls))
        return F.struct(x["start"].alias("start"), found.alias("found"))

    rows = rows.withColumn("__found", F.filter(F.transform("__ranges", high), lambda x: x["found"]["first"] >= 0))
    rows = rows.withColumn("__high", F.array_sort(F.transform("__found", lambda x: F.struct(
        (x["start"] + x["found"]["first"]).alias("start"), (x["start"] + x["found"]["last"]).alias("stop")))))
    fine = lambda s: ~is_allowed(F.substring(text, s["start"] + 1, s["stop"] - s["start"]), allowed)
    rows = rows.withColumn("__high", merged(F.filter("__high", fine)))
    rows = rows.withColumn("__high", F.filter(F.flatten(F.transform(
        "__high", lambda s: without_spans(s, F.col("__base")))), fine))
    fresh = F.transform("__high", lambda s: F.struct(
        s["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), s["stop"].alias("stop"), F.lit("entropy").alias("kind")))
    rows = rows.withColumn(spans, F.array_sort(F.concat(F.col("__base"), fresh)))
    return rows.drop("__base", "__parts", "__ranges", "__found", "__high", "__runs", *(f"__whole_{k.name}" for k in KINDS))


def bounded(run: Column, allowed: tuple[str, ...]) -> Column:
    """``run`` with blanks for UUIDs and for words that say they are examples, as far as ``allowed`` has these."""
    if ALLOWED[4] in allowed:
        run = F.regexp_replace(run, f"(?<![0-9A-Za-z]){_UUID}(?![0-9A-Za-z])", " " * 36)
    if ALLOWED[3] in allowed:
        words = F.transform(F.regexp_extract_all(run, F.lit("[0-9A-Za-z]+|[^0-9A-Za-z]"), F.lit(0)),
                            lambda w: F.when(w.rlike(_EXAMPLE), F.repeat(F.lit(" "), F.length(w))).otherwise(w))
        run = F.when(run.rlike(_EXAMPLE), F.array_join(words, "")).otherwise(run)
    return run


def candidates_of(cls: CharClass, closed: tuple[str, ...]):
    """What makes ``start, rank, run`` of the candidates of a class from a part ``start, run`` of the text."""
    def of(part: Column) -> Column:
        whole = F.regexp_extract_all(part["run"], F.lit(cls.pattern), F.lit(0))
        found = spans_of(part["run"], cls.pattern, whole, CLASSES.index(cls), cls.name,
                         keep=lambda run: run.rlike(_NEW[cls.name]) & ~is_allowed(run, closed))
        return F.transform(found, lambda s: F.struct(
            (part["start"] + s["start"]).alias("start"), s["rank"].alias("rank"),
            F.substring(part["run"], s["start"] + 1, s["stop"] - s["start"]).alias("run")))

    return of


_STRETCHES = "array<struct<start:int,stop:int>>"


def _stretch(start: Column, stop: Column) -> Column:
    return F.array(F.struct(start.alias("start"), stop.alias("stop")))


def merged(stretches: Column) -> Column:
    """Stretches in order of start, those that overlap made one."""
    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["stop"]
        done = F.when(new & (acc["start"] >= 0), F.concat(acc["done"], _stretch(acc["start"], acc["stop"]))).otherwise(acc["done"])
        return F.struct(F.when(new, s["start"]).otherwise(acc["start"]).alias("start"),
                        F.greatest(acc["stop"], s["stop"]).alias("stop"), done.alias("done"))

    begin = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("stop"), F.array().cast(_STRETCHES).alias("done"))
    return F.aggregate(stretches, begin, step, lambda acc: F.when(
        acc["start"] >= 0, F.concat(acc["done"], _stretch(acc["start"], acc["stop"]))).otherwise(acc["done"]))


def without_spans(stretch: Column, spans: Column) -> Column:
    """The stretches that are left of one outside ``spans``, which are in order of start."""
    def step(acc: Column, b: Column) -> Column:
        left = F.when(b["start"] > acc["at"], F.concat(acc["left"], _stretch(acc["at"], b["start"]))).otherwise(acc["left"])
        return F.struct(F.greatest(acc["at"], b["stop"]).alias("at"), left.alias("left"))

    touching = F.filter(spans, lambda b: (b["start"] < stretch["stop"]) & (stretch["start"] < b["stop"]))
    begin = F.struct(stretch["start"].alias("at"), F.array().cast(_STRETCHES).alias("left"))
    return F.aggregate(touching, begin, step, lambda acc: F.when(
        acc["at"] < stretch["stop"], F.concat(acc["left"], _stretch(acc["at"], stretch["stop"]))).otherwise(acc["left"]))


def is_allowed(run: Column, allowed: tuple[str, ...] = ALLOWED) -> Column:
    return run.rlike("|".join(f"^(?:{pattern})$" for pattern in allowed)) if allowed else F.lit(False)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every stretch that spans cover replaced by ``mark``; overlapping spans make one stretch."""
    def step(acc: Column, s: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        new = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(new, F.concat(acc["out"], between, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def without_secrets(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by a mark, all columns; a column of text lengths follows the text."""
    rows = with_spans(docs.withColumn("__text", F.coalesce(docs[text_col], F.lit(""))), "__text", spans="__spans")
    found = F.size("__spans") > 0
    rows = rows.withColumn(text_col, F.when(found, redacted(F.col("__text"), F.col("__spans"))).otherwise(F.col(text_col)))
    if chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        rows = rows.withColumn(chars_col, F.when(found, F.length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return rows.select(*docs.columns)

"""Personal data: fixed patterns, and contextual patterns bootstrapped from what they find.

The fixed patterns give seed entities. Words around them make lexical patterns, and every place that looks like
an identifier is an instance in its own patterns. Spark scores this graph in turns: a pattern is as good as the
share of its distinct instances that are entities, an instance as good as its patterns together. Patterns of high
confidence at the end mark the other places they match, as entities of the kind they were learnt from.

Edges are distinct before they are summed, so a value or a pattern found very often counts once per partner.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from tidemark.llm.common import packed, saved, whole

BASE_KINDS = ("email", "ip", "card", "phone")
#: The kinds in the order of spans that begin at the same place; the later ones are found by context.
KINDS = (*BASE_KINDS, *(f"context_{k}" for k in BASE_KINDS))

EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
EMAIL_HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARKS = re.compile("[0-9@]")
SPACE = re.compile(r"[\x20\x09-\x0D]")
TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: A word of digit groups; and such words, each joined by a single space, as long as whole words go on.
GROUPS = re.compile(r"[+(\[]*[0-9]+(?:[()\[\].-]{1,3}[0-9]+)*[)\]]?")
RUN = re.compile(GROUPS.pattern + r"(?:\x20[(\[]*[0-9]++(?:[()\[\].-]{1,3}[0-9]++)*+[)\]]?(?![^\s\"'`()\[\]{}<>,;!?.*#$%&|]))*+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EDGE = "\"'`()[]{}<>,;!?.*#$%&|"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:  # a name can't hold an @, so the leftmost match begins where its run of characters does
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = EMAIL_HOST.match(text, at) if start < at else None
        if host:
            yield start, host.end()
        done = host.end() if host else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, in code points, by start and kind."""
    out = [(0, a, b) for a, b in _emails(text)]
    if MARKS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((1, m.start(), m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in PHONE.finditer(text):
            if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def _shape(value: str) -> str:
    kinds = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", "9", value))
    return kinds if len(kinds) <= 12 else "mixed"


def slots(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, list[str]]]:
    """``(kind or -1, start, end, value, patterns)``: the spans, and other words with a digit or an @, of any length.

    Groups of digits joined by single spaces, hyphens, dots or brackets are one place as long as they go on.
    Patterns: the two words before; the word on either side; the word before and the value's shape.
    Digits in these words are made alike.
    """
    places = [(k, a, b) for k, a, b in spans]
    ends, at = sorted((a, b) for _, a, b in spans), 0
    i = 0
    while mark := MARKS.search(text, at):
        p = mark.start()
        while i < len(ends) and ends[i][1] <= p:
            i += 1
        if i < len(ends) and ends[i][0] <= p:
            at = ends[i][1]
            continue
        low = max(ends[i - 1][1] if i else 0, at)
        high = ends[i][0] if i < len(ends) else len(text)
        start = p
        while start > low and not SPACE.match(text, start - 1):
            start -= 1
        found = SPACE.search(text, p, high)
        end = found.start() if found else high
        start, end = _trimmed(text, start, end)
        if start < end and GROUPS.fullmatch(text, start, end):
            end = RUN.match(text, start, high).end()
        if MARKS.search(text, start, end):
            places.append((-1, start, end))
        at = max(end, p + 1)
    return [(k, a, b, text[a:b], _patterns(text, a, b)) for k, a, b in places]


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without marks at the edges, but with a bracket around the first group of digits."""
    word = text[start:end]
    left, right = start + len(word) - len(word.lstrip(EDGE)), end - (len(word) - len(word.rstrip(EDGE)))
    bracket = left > start and text[left - 1] in "([" and any(c in ")]" for c in text[left:end])
    return left - bracket, max(left, right)


def _alike(word: str) -> str:
    return re.sub("[0-9]+", "0", word.encode().lower().decode().strip("\"'`()[]{}<>,;!?.*"))


def _patterns(text: str, start: int, end: int) -> list[str]:
    before = TOKEN.findall(text[max(0, start - 120):start])[-2:]
    after = TOKEN.search(text, end, end + 60)
    left = [_alike(w[-60:]) for w in before]
    right = _alike(after[0]) if after else ""
    two, one = " ".join(left), left[-1] if left else ""
    return [f"2 {two}", f"1 {one} _ {right}", f"s {one} {_shape(text[start:end])}"]


def find(docs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``rid, row, spans, slots`` for each document, written once. A null text is an empty one."""
    import xxhash

    kind = ("struct<spans: array<struct<kind: int, start: int, end: int>>, slots: array<struct<kind: int, "
            "start: int, end: int, value: bigint, patterns: array<bigint>>>>")

    def number(value: str) -> int:
        n = xxhash.xxh64_intdigest(value.encode())
        return n - (1 << 64) if n >> 63 else n

    @pandas_udf(kind)
    def found(texts: pd.Series) -> pd.DataFrame:
        spans, places = [], []
        for text in texts:
            own = base_spans(text)
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in own])
            places.append([{"kind": k, "start": a, "end": b, "value": number(v), "patterns": [number(p) for p in ps]}
                           for k, a, b, v, ps in slots(text, own)])
        return pd.DataFrame({"spans": spans, "slots": places})

    rows = packed(docs, found(whole(docs["text"])).alias("f"))
    return saved(rows.select(F.monotonically_increasing_id().alias("rid"), F.struct(
        *[F.col("row").getField(c).alias(c) for c in columns or docs.columns]).alias("row"), "f.spans", "f.slots"),
        "personal-found")


def bootstrap(places: DataFrame, *, rounds: int, confidence: float, support: int) -> DataFrame:
    """``(pattern, kind, confidence)`` of the patterns kept after the last round.

    ``places`` are ``kind, value, patterns``. A pattern's confidence is the summed score of its distinct
    instances over their number plus one; it needs ``confidence`` and a summed score of ``support``.
    """
    edges = saved(places.select("value", F.explode("patterns").alias("pattern")).distinct(), "personal-edges")
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    seeds = saved(places.where("kind >= 0").select("value", "kind").distinct().withColumn("score", F.lit(1.0)),
                  "personal-seeds")
    scores, patterns = seeds, None
    for _ in range(rounds):
        sums = edges.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("good"))
        patterns = saved(sums.where(F.col("good") >= support).join(sizes, "pattern").select(
            "pattern", "kind", F.round(F.col("good") / (F.col("n") + 1), 9).alias("confidence")).where(
            F.col("confidence") >= confidence), "personal-patterns")
        together = edges.join(patterns, "pattern").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("score"))
        scores = saved(together.unionByName(seeds).groupBy("value", "kind").agg(F.max("score").alias("score")),
                       "personal-scores")
    return patterns


def personal_data(docs: DataFrame, columns: list[str] | None = None, *, rounds: int = 3, confidence: float = 0.8,
                  support: int = 5) -> DataFrame:
    """``rid, row, spans`` for each document: all spans ``(kind, start, end)``, by start and kind (see ``KINDS``).

    Positions are code points of the whole text, ends exclusive. A null or empty text has no spans.
    Rows may repeat and ids may be null.
    """
    rows = find(docs, columns)
    places = rows.select("rid", F.explode("slots").alias("s")).select("rid", "s.*")
    learnt = bootstrap(places, rounds=rounds, confidence=confidence, support=support)
    best = F.max(F.struct("confidence", (-F.col("k")).alias("k")))
    more = places.where("kind < 0").select("rid", "start", "end", F.explode("patterns").alias("pattern")).join(
        learnt.withColumnRenamed("kind", "k"), "pattern").groupBy("rid", "start", "end").agg(best.alias("best"))
    more = more.select("rid", F.struct((len(BASE_KINDS) - F.col("best.k")).alias("kind"), "start", "end").alias("s"))
    # No more than a text has words. Stored, so Spark knows the size and moves no texts to meet a small table.
    more = saved(more.groupBy("rid").agg(F.collect_list("s").alias("more")), "personal-contexts")
    spans = F.concat("spans", F.coalesce("more", F.array().cast("array<struct<kind: int, start: int, end: int>>")))
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"),
                                                                  s["end"].alias("end"))))
    ordered = F.transform(by_start, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.join(more, "rid", "left").select("rid", "row", ordered.alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])))


def redact(text: str, spans: list) -> str:
    """The text with each span replaced by its kind; spans that overlap become one, of the first one's kind."""
    out, done, upto = [], 0, -1
    for kind, start, end in spans:
        if start >= upto:
            out += [text[done:start], f"<{KINDS[kind].removeprefix('context_').upper()}>"]
        upto = max(upto, end)
        done = upto
    return "".join([*out, text[done:]])


@pandas_udf(StringType())
def redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or not len(s) else redact(t, [(x["kind"], x["start"], x["end"]) for x in s])
                      for t, s in zip(texts, spans)], dtype=object)

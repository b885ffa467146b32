"""Personal data: fixed patterns, then identifiers that stand in the same contexts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.schema import shared_dir

from .common import bounded_batches, store

#: Kinds in the order in which spans that start together are listed; those found by context
#: carry the kind that they resemble.
BASE_KINDS = ("email", "ip", "card", "phone")
NEAR_KINDS = tuple(f"near_{kind}" for kind in BASE_KINDS)
KINDS = BASE_KINDS + NEAR_KINDS

#: Rounds of scoring; seeds that a pattern needs; scores that a pattern and an instance need.
ROUNDS = 3
MIN_SEEDS = 5
MIN_PATTERN = 0.5
MIN_INSTANCE = 0.8
#: Words of a context, and characters before the identifier in which they are looked for.
CONTEXT_WORDS = 2
CONTEXT_CHARS = 80
#: Longest parts of an address before and after the @ (RFC 5321), and longest IP-like token.
LONGEST_LOCAL = 64
LONGEST_HOST = 255
LONGEST_IP = 64
#: Digits of a phone and of a card number.
PHONE_DIGITS = (7, 15)
CARD_DIGITS = (12, 19)

# Possessive repeats change no match here and keep long runs of digits linear: what follows
# a repeat is never a character that the repeat takes.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
LAST_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
MARK = re.compile(r"[0-9@]")

# Loose shapes of identifiers that the base patterns miss. TAKEN stands for characters that
# belong to another identifier.
TAKEN = "\uffff"
BREAKS = r"\s\"'(),:;<>@\[\]\\{}/=&?|\u3000-\u303f\uff00-\uff20\uffff"
#: Scripts whose words stand next to an address without a space.
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff\uff00-\uffef\U00020000-\U0003ffff"
NEAR_EMAIL = [re.compile(f"[^{BREAKS}{UNSPACED}]++"), re.compile(f"[^{BREAKS}]++")]
TOKEN = re.compile(r"[0-9A-Za-z_*.:%-]++")
QUAD = re.compile(r"(?<![0-9A-Za-z.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9A-Za-z]|\.[0-9])")
#: Groups of digits joined by dots, dashes, brackets, or by a space with them.
NUMBERS = re.compile(
    r"(?:[+(]{1,2}|(?<![0-9A-Za-z_\uffff]))[0-9]++(?:(?:[().+-]++|[)-]?\x20[.-]?\x20?\(?)[0-9]++)*(?![0-9A-Za-z_\uffff])"
)
WORD_OF_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[^\x20]*[0-9])?")
GROUP = re.compile(r"[+(]{0,2}[0-9]++")
#: Usual groups of phones and cards: where one number ends in a row of several.
GROUPED = re.compile(
    r"(?:(?:(?:\+[0-9]{1,3}|1)[\x20.-])?\(?[0-9]{3}\)?[\x20.-]{0,2}[0-9]{3}[\x20.-][0-9]{4}"
    r"|[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5}"
    r"|\(?0[0-9]{1,4}\)?[\x20.-][0-9]{5,11}|0[0-9](?:[\x20.-][0-9]{2}){4})(?![0-9])"
)
EDGES = ".,;:!?\"'()[]{}<>"

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _ascii_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[Span]:
    """From each @ to both sides, which finds what the pattern finds from the left: the
    leftmost match starts at the first character that may stand before this @."""
    found, after = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > after and LOCAL.match(text[start - 1]):
            start -= 1
        end = at + 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            found.append(("email", start, domain.end()))
            end = after = domain.end()
        else:
            after = at + 1
        at = text.find("@", end)
    return found


def base_spans(text: str) -> list[Span]:
    """Spans of the four fixed kinds, by start and then kind.

    Per kind, matches are leftmost and don't overlap; one that fails its check is dropped
    with all its characters.
    """
    found = emails(text) if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = _ascii_digits(m[0]) if m.end() - m.start() <= 2 * 19 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= len(_ascii_digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def context(text: str, start: int) -> str:
    """The words before an identifier, lower-cased: the pattern that it stands in.

    A word that begins before the characters looked at is no word of a context.
    """
    first = max(0, start - CONTEXT_CHARS)
    words = text[first:start].lower().split()
    if first and words and not text[first - 1].isspace() and not text[first].isspace():
        words = words[1:]
    return " ".join(words[-CONTEXT_WORDS:])


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the spans' characters replaced, so that no shape reaches into them."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if end > at:
            parts += [text[at:start], TAKEN * (end - max(start, at))]
            at = end
    return "".join([*parts, text[at:]])


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    while start < end and text[start] in EDGES:
        start += 1
    while start < end and text[end - 1] in EDGES:
        end -= 1
    return start, end


def _near_emails(text: str) -> list[tuple[int, int]]:
    """local@host of any letters, wherever it stands in a run of characters."""
    found, after = [], 0
    at = text.find("@")
    while at >= 0:
        start, host, least = at, None, max(after, at - LONGEST_LOCAL - 1)
        for part in NEAR_EMAIL:
            if start == at:
                while start > least and part.match(text[start - 1]):
                    start -= 1
            host = host or part.match(text, at + 1)
        end = at + 1
        if start < at and host:
            end = host.end()
            own = _trimmed(text, start, end)
            if at - own[0] <= LONGEST_LOCAL and own[1] - at - 1 <= LONGEST_HOST and own[0] < at < own[1] - 1:
                found.append(own)
        after = end
        at = text.find("@", end)
    return found


def _near_ips(text: str) -> list[tuple[int, int]]:
    """Tokens that look like addresses; of longer tokens the four groups of digits in them."""
    found = []
    for m in TOKEN.finditer(text):
        if m.end() - m.start() < 5:
            continue
        start, end = _trimmed(text, *m.span())
        if end - start > LONGEST_IP:
            found += [q.span() for q in QUAD.finditer(text, start, end)]
        elif "ip" in resembles(text[start:end]):
            found.append((start, end))
    return found


def _near_numbers(text: str) -> list[tuple[int, int]]:
    """Numbers of seven to nineteen digits, with spaces between their groups or without.

    A run of groups may hold several numbers. Usual groups are taken first, then a word that
    has enough digits by itself, else as many words as a number may have digits.
    """
    found = []
    for m in NUMBERS.finditer(text):
        if m.end() - m.start() < PHONE_DIGITS[0]:
            continue
        units = []
        for w in WORD_OF_NUMBER.finditer(text, *m.span()):
            n = len(_ascii_digits(w[0]))
            if n <= CARD_DIGITS[1]:
                units.append((*w.span(), n))
            else:
                units += [(*g.span(), len(_ascii_digits(g[0]))) for g in GROUP.finditer(text, *w.span())]
        place = {end: i for i, (_, end, _) in enumerate(units)}
        rest = sum(n for _, _, n in units)
        usual = [(g := GROUPED.match(text, start, m.end())) and place.get(g.end()) for start, _, _ in units]
        i = 0
        while i < len(units):
            n, last = units[i][2], i
            if usual[i] is not None:
                last = usual[i]
                n = sum(u[2] for u in units[i : last + 1])
            elif n < PHONE_DIGITS[0]:
                most = CARD_DIGITS[1] if rest <= CARD_DIGITS[1] else PHONE_DIGITS[1]
                for j in range(i + 1, len(units)):
                    if n + units[j][2] > most or units[j][2] >= PHONE_DIGITS[0] or usual[j] is not None:
                        break
                    n, last = n + units[j][2], j
            if PHONE_DIGITS[0] <= n <= CARD_DIGITS[1]:
                start, end = units[i][0], units[last][1]
                own = text[start:end]
                # A bracket around the whole number is none of its characters.
                if "(" in own and ")" not in own:
                    start += own.index("(") + 1 if own.index("(") < 2 else 0
                found.append((start, end))
            rest -= sum(u[2] for u in units[i : last + 1])
            i = last + 1
    return found


def candidates(text: str, spans: list[Span]) -> list[tuple[int, int]]:
    """What has the loose shape of an identifier and touches no span, by start, none overlapping.

    Shapes are found anywhere: with spaces between groups of digits, or inside a long run of
    characters without any space.
    """
    if not MARK.search(text):
        return []
    left = _without(text, [(s, e) for _, s, e in spans])
    found: list[tuple[int, int]] = []
    for shape in (_near_emails, _near_ips, _near_numbers):
        own = shape(left)
        if own:
            found += own
            left = _without(left, own)
    return sorted((s, e) for s, e in found if e - s >= 5)


def resembles(word: str) -> list[str]:
    """The kinds whose outer form a word has."""
    digits = len(_ascii_digits(word))
    numeric = not re.search(r"[^0-9\x20().+-]", word)
    forms = {
        "email": "@" in word[1:],
        "ip": digits >= 4 and len(re.findall(r"[.:]", word)) >= 3,
        "card": numeric and CARD_DIGITS[0] <= digits <= CARD_DIGITS[1],
        "phone": numeric and PHONE_DIGITS[0] <= digits <= PHONE_DIGITS[1],
    }
    return [kind for kind in BASE_KINDS if forms[kind]]


EDGE = "struct<pattern:string,instance:string,seed:string,forms:array<string>,start:long,end:long>"
FOUND = f"spans array<struct<start:long,kind:int,end:long>>, base_sha256 string, edges array<{EDGE}>"


def _spans_and_edges(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(f"doc_id {doc_type}, {FOUND}")
    types = list(to_arrow_schema(schema).types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[], [], []]
            for text in batch.column("text").to_pylist():
                text = text or ""
                base = base_spans(text)
                listed = ",".join(f"{kind}:{start}:{end}" for kind, start, end in base)
                edges = [(context(text, s), text[s:e].lower(), kind, None, s, e) for kind, s, e in base]
                for s, e in candidates(text, base):
                    forms = resembles(text[s:e])
                    if forms:
                        edges.append((context(text, s), text[s:e].lower(), None, forms, s, e))
                columns[0].append([{"start": s, "kind": KINDS.index(k), "end": e} for k, s, e in base])
                columns[1].append(hashlib.sha256(listed.encode()).hexdigest())
                names = ("pattern", "instance", "seed", "forms", "start", "end")
                columns[2].append([dict(zip(names, edge)) for edge in edges if edge[0]])
            arrays = [pa.array(c, t) for c, t in zip(columns, types[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def score_instances(edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """``(instance, kind, score)`` of identifiers that are no seeds, by the graph of patterns.

    ``edges(pattern, instance, seed, forms)``: ``seed`` is the kind of a seed, ``forms`` the
    kinds that another identifier resembles. Each round a pattern may speak for a kind if
    ``min_seeds`` of its different identifiers are seeds of that kind: base ones, or identifiers
    that reached ``MIN_INSTANCE`` in the round before, so what one pattern discovers induces the
    next. A pattern's score is the mean score of all its different identifiers; an identifier's
    score is the noisy-or of its patterns' scores, for kinds that it resembles. Base seeds keep
    score one. Everything is counted over different (pattern, instance) pairs, added up before
    the shuffle; a frequent pattern meets its identifiers in a join whose hot keys Spark splits.
    """
    shared_dir(edges.sparkSession)
    pairs = edges.groupBy("pattern", "instance").agg(
        F.max("seed").alias("seed"), F.max("forms").alias("forms")
    ).checkpoint()
    sizes = pairs.groupBy("pattern").agg(F.count("*").alias("n"))
    base = (
        pairs.where("seed IS NOT NULL")
        .groupBy("pattern", F.col("seed").alias("kind"))
        .agg(F.count("*").alias("seeds"), F.count("*").cast("double").alias("mass"))
        .join(sizes, "pattern")
        .checkpoint()
    )
    open_pairs = (
        pairs.where("seed IS NULL")
        .select("pattern", "instance", F.explode("forms").alias("kind"))
        .join(sizes, "pattern")
        .checkpoint()
    )
    scores = None
    for _ in range(rounds):
        support = base
        if scores is not None:
            gained = (
                open_pairs.join(scores, ["instance", "kind"])
                .groupBy("pattern", "kind")
                .agg(
                    F.count_if(F.col("score") >= MIN_INSTANCE).alias("seeds"),
                    F.sum("score").alias("mass"),
                    F.max("n").alias("n"),
                )
            )
            support = (
                base.unionByName(gained)
                .groupBy("pattern", "kind")
                .agg(F.sum("seeds").alias("seeds"), F.sum("mass").alias("mass"), F.max("n").alias("n"))
            )
        mean = support.where(F.col("seeds") >= min_seeds).select("pattern", "kind", (F.col("mass") / F.col("n")).alias("score"))
        good = mean.where(F.col("score") >= MIN_PATTERN)
        miss = F.sum(F.log1p(-F.least(F.col("score"), F.lit(1 - 1e-9))))
        scores = (
            open_pairs.select("pattern", "kind", "instance")
            .join(good, ["pattern", "kind"])
            .groupBy("instance", "kind")
            .agg((1 - F.exp(miss)).alias("score"))
            .checkpoint()
        )
    return scores


def find_personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row of ``docs``.

    ``spans`` lists ``kind:start:end`` (code points, end exclusive) by start, then kind;
    ``base_sha256`` is the digest of the list of the four base kinds. Identifiers found by
    context are added as ``near_<kind>`` and never touch a base span. NULL counts as the empty
    text: no spans, digest of the empty string. Rows that repeat come back as often; rows
    without ``doc_id`` too; no rows give none; other columns are ignored.
    """
    found = store(
        _spans_and_edges(docs).withColumn("row", F.monotonically_increasing_id()), "personal"
    )
    edges = found.select("row", F.explode("edges").alias("e")).select("row", "e.*")
    scores = score_instances(edges.select("pattern", "instance", "seed", "forms"))
    best = scores.where(F.col("score") >= MIN_INSTANCE).groupBy("instance").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))
    number = F.array_position(F.array(*map(F.lit, BASE_KINDS)), F.col("kind")) - 1 + len(BASE_KINDS)
    added = (
        edges.where("seed IS NULL")
        .select("row", "instance", "start", "end")
        .join(best, "instance")
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", number.cast("int").alias("kind"), "end")).alias("added"))
    )
    names = F.array(*map(F.lit, KINDS))
    every = F.array_sort(F.concat("spans", F.coalesce("added", F.expr("cast(array() as array<struct<start:long,kind:int,end:long>>)"))))
    line = F.transform(every, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"]))

    def count(kind: int):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("row", "doc_id", "spans", "base_sha256").join(added, "row", "left").select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(BASE_KINDS)],
        "base_sha256",
        F.array_join(line, ",").alias("spans"),
    )

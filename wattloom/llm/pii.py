"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

1. Base patterns find e-mail and network addresses, card and phone numbers in every text.
   These spans are the seeds.
2. Candidates are other texts that have the form of an identifier of some kind: number
   groups of seven to twelve digits, or of 13 to 19 with a right check digit, spelled-out
   e-mail addresses, hexadecimal network addresses.
3. The words around a seed or a candidate are lexical patterns (one or two words before,
   a word before with the word after). Patterns and the identifiers they stand next to
   form a graph, which Spark scores in rounds: a pattern is trusted as far as what it
   stands next to, in all texts, is a known identifier rather than an unknown one or
   none. An identifier becomes known if its contexts make it likely enough; a context has
   one vote, that of its best pattern, and the identifier in question does not count
   in it. Each round learns new identifiers and with them new patterns, until a round
   learns nothing.
4. Known candidates are added to the base spans wherever they stand next to a trusted
   pattern.

Rows: a null or empty text has no spans. Repeated documents keep their rows. Base spans
of a kind never overlap; a candidate that overlaps a base span is not considered.
Positions count code points, ends are exclusive. Only key and text are read.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common

KINDS = ["email", "ip", "card", "phone"]
#: Different known identifiers that a pattern needs beside it, and the share that known
#: ones have in all its occurrences.
LEAST_KNOWN = 5
LEAST_TRUST = 0.6
#: Likelihood from which a candidate is known.
LEAST_LIKELY = 0.9
#: Rounds end when one learns nothing; so many are taken for a mistake.
MOST_ROUNDS = 1_000

# Fixed patterns of the base.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Starting only where a run of digits does finds the same and stays linear in long runs.
_ADDRESS = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

# Forms of candidates.
_SPELLED = re.compile(
    r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]{0,63} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}){1,5}"
)
_HEXADECIMAL = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
_NUMBER = re.compile(r"(?<![\w.+/-])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![\w/-]|\.[0-9])")
_WORD = re.compile(r"[^\W\d_]+")
#: Slots of the bitmap that tells which word groups may be patterns, and words of a text
#: looked at together.
_SLOTS = 1 << 24
_CHUNK = 200_000


def _is_address(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in text.split("."))


def _is_card(text: str, least: int = 16) -> bool:
    digits = _NO_DIGIT.sub("", text)
    if not least <= len(digits) <= 19:
        return False
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost addresses: from each @ back over the characters of a local part."""
    found, done = [], 0
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                found.append((start, done))
        at = text.find("@", at + 1)
    return found


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in order of kind and start."""
    text = text or ""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [("ip", *m.span()) for m in _ADDRESS.finditer(text) if _is_address(m[0])]
        spans += [("card", *m.span()) for m in _CARD.finditer(text) if _is_card(m[0])]
        if "+" in text:
            phones = ((m, len(_NO_DIGIT.sub("", m[0]))) for m in _PHONE.finditer(text))
            spans += [("phone", *m.span()) for m, digits in phones if 8 <= digits <= 15]
    return spans


def candidate_spans(text: str | None, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of texts in the form of an identifier, clear of base spans and
    of each other."""
    text = text or ""
    found = []
    if "at" in text and any(mark in text for mark in ("(at)", "[at]", "{at}")):
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if ":" in text:
        found += [("ip", *m.span()) for m in _HEXADECIMAL.finditer(text)]
    if _DIGIT.search(text):
        for m in _NUMBER.finditer(text):
            digits = len(_NO_DIGIT.sub("", m[0]))
            if digits <= 12 or _is_card(m[0], 13):
                found.append(("phone" if digits <= 12 else "card", *m.span()))
    taken = sorted((start, end) for _, start, end in base)
    clear, place, reached = [], 0, 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        while place < len(taken) and taken[place][1] <= start:
            place += 1
        if start >= reached and (place == len(taken) or taken[place][0] >= end):
            clear.append((kind, start, end))
            reached = end
    return clear


def identity(kind: str, text: str) -> str:
    """One writing of an identifier: digits of numbers, lower case of the rest."""
    return _NO_DIGIT.sub("", text) if kind in ("card", "phone") else text.lower().replace(" ", "")


def contexts(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    """Lexical patterns around each span; words of the identifier itself do not count."""
    words = [(m[0], *m.span()) for m in _WORD.finditer(text.lower())] if spans else []
    starts, ends = [w[1] for w in words], [w[2] for w in words]
    found = []
    for start, end in spans:
        at, to = bisect.bisect_right(ends, start), bisect.bisect_left(starts, end)
        patterns = []
        if at:
            patterns.append(f"{words[at - 1][0]} _")
            if to < len(words):
                patterns.append(f"{words[at - 1][0]} _ {words[to][0]}")
        if at > 1:
            patterns.append(f"{words[at - 2][0]} {words[at - 1][0]} _")
        found.append(patterns)
    return found


_SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
_MENTION = T.StructType(
    [
        *_SPAN.fields,
        T.StructField("seed", T.BooleanType()),
        T.StructField("identity", T.StringType()),
        T.StructField("patterns", T.ArrayType(T.StringType())),
    ]
)


def scan(docs: DataFrame, kept: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``_base`` spans and ``_mentions`` (seeds and candidates with
    their contexts) of every document; written, as every round reads it."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    mention = pa.struct([*span, ("seed", pa.bool_()), ("identity", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bases, mentions = [], []
        for value in batch.column(text).to_pylist():
            base = base_spans(value)
            both = [(True, *s) for s in base] + [(False, *s) for s in candidate_spans(value, base)]
            around = contexts(value or "", [s[2:] for s in both])
            bases.append([dict(zip(("kind", "start", "end"), s)) for s in base])
            mentions.append(
                [
                    {
                        "kind": kind,
                        "start": start,
                        "end": end,
                        "seed": seed,
                        "identity": identity(kind, value[start:end]),
                        "patterns": patterns,
                    }
                    for (seed, kind, start, end), patterns in zip(both, around)
                ]
            )
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(bases, pa.list_(span)), pa.array(mentions, pa.list_(mention))],
            names=[*kept, "_base", "_mentions"],
        )

    fields = [
        *(common.renamed(docs.schema[c], c) for c in kept),
        T.StructField("_base", T.ArrayType(_SPAN)),
        T.StructField("_mentions", T.ArrayType(_MENTION)),
    ]
    return common.staged(common.map_batches(docs.select(*dict.fromkeys([*kept, text])), run, fields), "mentions")


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        # Kept for frequent words; emptied before it grows with the text.
        if len(self) > _CHUNK:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "surrogatepass")) if word else 0
        return value


def _slots(form: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + (second + np.uint64(form)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(40)).astype(np.int64)


def _parts(pattern: str) -> tuple[int, str, str]:
    """(form, first word, second word) of a pattern."""
    words = pattern.split(" ")
    if len(words) == 2:
        return 1, words[0], ""
    return (2, words[0], words[1]) if words[2] == "_" else (3, words[0], words[2])


_FORMS = {1: "{0} _", 2: "{0} {1} _", 3: "{0} _ {1}"}


def _bitmap(patterns: DataFrame) -> np.ndarray:
    """Slots of all patterns, one bitmap of fixed size from each of at most eight tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, hashes = np.zeros(_SLOTS, bool), _Hashes()
        for batch in batches:
            for pattern in batch.column(0).to_pylist():
                form, *words = _parts(pattern)
                marks[_slots(form, *(np.array([hashes[w]], np.uint64) for w in words))] = True
        if marks.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(marks).tobytes()], pa.binary())], names=["marks"])

    found = np.zeros(_SLOTS // 8, np.uint8)
    for row in patterns.select("pattern").coalesce(8).mapInArrow(run, "marks binary").collect():
        found |= np.frombuffer(row["marks"], np.uint8)
    return found


def occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, n) of those ``patterns`` whose words occur in ``texts``: a word, two
    words, or two words with any one between them."""
    bits = _bitmap(patterns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, hashes = np.unpackbits(bits).view(bool), _Hashes()
        for batch in batches:
            texts = (t for t in batch.column(0).to_pylist() if t)
            # Empty words keep the words of two texts apart.
            stream = (w for t in texts for w in itertools.chain(("", ""), (m[0] for m in _WORD.finditer(t.lower()))))
            counts: Counter = Counter()
            words = ["", ""]
            while len(words := [*words[-2:], *itertools.islice(stream, _CHUNK)]) > 2:
                hashed = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                none = np.zeros(len(words) - 2, np.uint64)
                for form, first, second in ((1, 0, None), (2, 1, 0), (3, 2, 0)):
                    stop = len(words)
                    one = hashed[2 - first : stop - first]
                    two = none if second is None else hashed[2:]
                    hits = np.flatnonzero(marks[_slots(form, one, two)]).tolist()
                    counts.update((form, words[k + 2 - first], "" if second is None else words[k + 2]) for k in hits)
            names = [_FORMS[form].format(one, two) for form, one, two in counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["pattern", "n"]
            )

    counted = texts.mapInArrow(run, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    return counted.join(patterns.select("pattern"), "pattern", "left_semi")


def outside(texts: DataFrame, mentions: DataFrame) -> DataFrame:
    """(pattern, outside): how often patterns that may be trusted, and stand beside a
    candidate, occur in ``texts`` without an identifier of any kind."""
    beside = mentions.select("kind", "identity", "seed", F.explode("patterns").alias("pattern"))
    by_identity = beside.groupBy("pattern", "kind", "identity").agg(F.count("*").alias("n"), F.min("seed").alias("seed"))
    by_kind = by_identity.groupBy("pattern", "kind").agg(
        F.sum("n").alias("n"), F.count("*").alias("different"), F.min("seed").alias("seed")
    )
    able = (
        by_kind.groupBy("pattern")
        .agg(F.sum("n").alias("beside"), F.max((F.col("different") > LEAST_KNOWN) & ~F.col("seed")).alias("able"))
        .where("able")
    )
    able = common.staged(able.select("pattern", "beside"), "able")
    # Words with one between them are no mention; the other forms count mentions as well.
    bare = F.when(F.col("pattern").rlike(" _ "), F.col("n")).otherwise(F.greatest(F.col("n") - F.col("beside"), F.lit(0)))
    return common.staged(occurrences(texts, able).join(able, "pattern").select("pattern", bare.alias("outside")), "outside")


def trusted(
    mentions: DataFrame, max_rounds: int = MOST_ROUNDS, outside: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(patterns, identities) after the last round: trusted (kind, pattern, trust) and
    newly known (kind, identity). ``mentions``: kind, identity, seed, patterns;
    ``outside``: how often a pattern stands beside none. What is known stays known, so
    that a round without new identities changes nothing any more."""
    graph = (
        mentions.withColumn("context", F.array_join("patterns", ","))
        .select("kind", "identity", "seed", "context", F.explode("patterns").alias("pattern"))
        .groupBy("kind", "identity", "pattern", "context")
        .agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    )
    if outside is None:
        graph = graph.withColumn("outside", F.lit(0).cast("long"))
    else:
        graph = graph.join(outside, "pattern", "left").withColumn("outside", F.coalesce("outside", F.lit(0)))
    graph = common.staged(graph, "graph")
    unknown = graph.groupBy("kind", "identity").agg(F.max("seed").alias("seed")).where("not seed").select("kind", "identity")
    known = None
    count = 0
    for _ in range(max_rounds):
        marked = graph if known is None else graph.join(known.withColumn("learned", F.lit(True)), ["kind", "identity"], "left")
        is_known = F.col("seed") if known is None else F.col("seed") | F.coalesce("learned", F.lit(False))
        by_identity = (
            marked.groupBy("kind", "pattern", "identity")
            .agg(F.sum("n").alias("n"), F.max(is_known).alias("is_known"), F.max("outside").alias("outside"))
        )
        patterns = common.staged(
            by_identity.groupBy("kind", "pattern")
            .agg(
                F.count_if("is_known").alias("different"),
                F.coalesce(F.sum(F.when(F.col("is_known"), F.col("n"))), F.lit(0)).alias("known"),
                (F.sum("n") + F.max("outside")).alias("all"),
            )
            .withColumn("trust", F.col("known") / F.col("all"))
            .where((F.col("different") >= LEAST_KNOWN) & (F.col("trust") >= LEAST_TRUST))
            .select("kind", "pattern", "trust", "known", "all"),
            "patterns",
        )
        # What an unknown identifier itself adds to the occurrences is left out.
        own = by_identity.where("not is_known").select("kind", "identity", "pattern", F.col("n").alias("own"))
        vote = F.col("known") / (F.col("all") - F.col("own"))
        likely = (
            own.join(patterns, ["kind", "pattern"])
            .select("kind", "identity", "pattern", vote.alias("vote"))
            .join(graph.select("kind", "identity", "pattern", "context"), ["kind", "identity", "pattern"])
            .groupBy("kind", "identity", "context")
            .agg(F.max("vote").alias("vote"))
            .groupBy("kind", "identity")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("vote"), F.lit(1e-9)))))).alias("likely"))
            .where(F.col("likely") >= LEAST_LIKELY)
            .select("kind", "identity")
        )
        likely = likely.join(unknown, ["kind", "identity"], "left_semi")
        known = common.staged(likely if known is None else likely.union(known), "known")
        learned = known.count()
        if learned == count:
            return patterns, known
        count = learned
    raise RuntimeError(f"personal data did not settle in {max_rounds} rounds")


def found_spans(scanned: DataFrame, row: str, texts: DataFrame) -> DataFrame:
    """(row, kind, start, end) of the candidates that bootstrapping adds."""
    mentions = scanned.select(row, F.explode("_mentions").alias("m")).select(row, "m.*")
    patterns, known = trusted(mentions, outside=outside(texts, mentions))
    beside = mentions.where("not seed").withColumn("pattern", F.explode("patterns"))
    return (
        beside.join(known, ["kind", "identity"], "left_semi")
        .join(patterns, ["kind", "pattern"], "left_semi")
        .select(row, "kind", "start", "end")
        .distinct()
    )


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, ``base`` and ``spans`` (arrays of kind, start, end; spans holds
    base and added ones)."""
    scanned = scan(docs.select(F.monotonically_increasing_id().alias("_row"), key, text), ["_row", key], text)
    found = found_spans(scanned, "_row", docs.select(text))
    added = found.groupBy("_row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("_added"))
    joined = scanned.select("_row", key, "_base").join(added, "_row", "left")
    return joined.select(
        key,
        F.col("_base").alias("base"),
        F.concat("_base", F.coalesce("_added", F.array().cast(T.ArrayType(_SPAN)))).alias("spans"),
    )


def ordered(column: str) -> F.Column:
    """Spans by kind as listed, then start."""
    ranked = F.transform(
        column,
        lambda x: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), x["kind"]).alias("rank"), x["start"], x["end"], x["kind"]
        ),
    )
    return F.array_sort(ranked)


def digest_text(column: str) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(ordered(column), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
    )


def redact(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with a mark in place of each span; overlapping spans get one mark."""
    out, done = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start < done:
            if end > done:
                done = end
            continue
        out += [text[done:start], f"<{kind}>"]
        done = end
    return "".join([*out, text[done:]])


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with personal data replaced by marks, other columns unchanged. Added
    spans are found per key and text, so repeated rows get the same."""
    docs, back = common.sheltered(docs, key, text)
    print_of = F.xxhash64(text)
    scanned = scan(docs.select(print_of.alias("_print"), key, text), ["_print", key], text)
    numbered = scanned.select(F.struct("_print", key).alias("_row"), "_mentions")
    added = (
        found_spans(numbered, "_row", docs.select(text))
        .groupBy("_row")
        .agg(F.collect_list(F.struct("kind", "start", "end")).alias("_added"))
        .select("_row._print", F.col(f"_row.{key}").alias("_key"), "_added")
    )
    marked = docs.withColumn("_print", print_of)
    joined = marked.join(added, marked["_print"].eqNullSafe(added["_print"]) & marked[key].eqNullSafe(added["_key"]), "left")
    wide = joined.select(*docs.columns, "_added")
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for value, more in zip(batch.column(text).to_pylist(), batch.column("_added").to_pylist()):
            found = base_spans(value) + [(s["kind"], s["start"], s["end"]) for s in more or ()]
            texts.append(value if value is None or not found else redact(value, found))
        new = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays([new if n == text else batch.column(n) for n in names], names=names)

    return back(common.map_batches(wide, run, [common.renamed(docs.schema[n], n) for n in names]))

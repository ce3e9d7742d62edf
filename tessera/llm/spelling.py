"""Spelling variants: words one edit apart, found by composing finite-state machines.

Words are runs of letters (``LETTERS``), lower-cased in A-Z only, with at least ``min_len``
code points and ``min_count`` occurrences in all texts.  Two words are near if one inserted,
deleted or replaced code point turns one into the other.  A word's form is its near word
that occurs most (ties: smallest in code-point order), if at least ``ratio`` times as often
as the word; forms occur ever more often, so following them ends at the root.

The near pairs are what the composition acceptor . one-edit transducer . acceptor accepts:

1. The acceptor of the vocabulary is cut by initial states.  Of a pair with ``m`` code
   points in its shorter word either the first ``m // 2`` agree (the edit comes later) or the
   last ``m - m // 2`` do.  So one partition is a shorter length, a direction and the state
   that an acceptor, of the words or of the words read backwards, is in after that half.
2. Each partition holds the minimised acceptor of what may follow that state and enumerates
   the pairs the composed machine accepts from there.  Only such a partition's words meet in
   a task.
3. A state with more than ``MOST_WORDS`` words is cut further, by the place of the edit and
   all code points around it; such a partition leaves one or two code points open, so it has
   at most as many words as the alphabet has pairs.

Counts are made per task before the shuffle, over whole texts.  Null and empty texts have no
words; a null id counts as an empty one in the edit of ``vocabulary``; repeated rows count as
often as they occur; words of any length are handled without recursion.  An empty table
gives an empty result.  Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
MIN_LEN, MIN_COUNT, RATIO = 6, 5, 5
#: One occurrence in so many (by a hash of document and word) loses a code point.
MISSPELT = 199
#: Words of one initial state that are composed in one partition.
MOST_WORDS = 20_000
#: Distinct words a task counts before it hands its counts on.
HELD_WORDS = 200_000


def misspelt(word: str, start: int) -> str:
    """The word, or without one code point where the hash says so; ``start`` is the id's crc32."""
    h = zlib.crc32(word.encode("utf-8"), start)
    if h % MISSPELT:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def vocabulary(df: DataFrame, text: str = "text", key: str = "doc_id", min_len: int = MIN_LEN,
               min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of all texts, some occurrences misspelt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counts() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                               pa.array(list(total.values()), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = body.as_py()
                if not raw:
                    continue
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                # bytes.lower() changes A-Z only
                low = raw.encode("utf-8", "replace").lower().decode("utf-8")
                for word, n in Counter(LETTERS.findall(low)).items():
                    if len(word) >= min_len:
                        word = misspelt(word, start)
                        if len(word) >= min_len:
                            total[word] += n
                if len(total) > HELD_WORDS:
                    yield counts()
                    total = Counter()
        if total:
            yield counts()

    return (df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


class Acceptor:
    """The minimised deterministic acceptor of sorted distinct words; state 0 is initial."""

    def __init__(self, words: list[str]):
        self.final, self.arcs = [False], [{}]
        known: dict = {}
        open_states: list[tuple[int, str, int]] = []

        def close(depth: int) -> None:
            # states behind ``depth`` can get no further arcs: merge each with its equal
            while len(open_states) > depth:
                state, letter, then = open_states.pop()
                self.arcs[state][letter] = known.setdefault(
                    (self.final[then], tuple(self.arcs[then].items())), then)

        last = ""
        for word in words:
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            close(same)
            state = open_states[-1][2] if open_states else 0
            for letter in word[same:]:
                self.final.append(False)
                self.arcs.append({})
                open_states.append((state, letter, len(self.arcs) - 1))
                self.arcs[state][letter] = state = len(self.arcs) - 1
            self.final[state] = True
            last = word
        close(0)


def one_edit_pairs(words: list[str]) -> set[tuple[str, str]]:
    """Pairs of sorted distinct words one edit apart: the shorter (or smaller) one first.

    States of the composed machine are (state, edited, state).  Unedited, both read the same
    letter; an edit replaces a letter by a larger one or inserts one into the first word;
    after it both read the same again.
    """
    machine = Acceptor(words)
    arcs, final = machine.arcs, machine.final
    found, waiting = set(), [(0, 0, False, "", "")]
    while waiting:
        p, q, edited, u, v = waiting.pop()
        if edited and final[p] and final[q]:
            found.add((u, v))
        if not edited:
            for b, y in arcs[q].items():
                waiting.append((p, y, True, u, v + b))
                waiting.append((y, y, False, u + b, v + b))
                waiting += [(x, y, True, u + a, v + b) for a, x in arcs[p].items() if a < b]
        elif p == q or len(arcs[p]) <= len(arcs[q]):
            waiting += [(x, arcs[q][a], True, u + a, v + a) for a, x in arcs[p].items() if a in arcs[q]]
        else:
            waiting += [(arcs[p][b], y, True, u + b, v + b) for b, y in arcs[q].items() if b in arcs[p]]
    return found


def initial_states(words: DataFrame) -> DataFrame:
    """(m, part, word, n): a word's partitions by shorter length, direction and half."""
    m, half = F.col("m"), (F.col("m") / 2).cast("int")
    return (words.select("word", "n", F.length("word").alias("size"))
            .select("word", "n", F.explode(F.array(F.col("size"), F.col("size") - 1)).alias("m"))
            .select("m", F.explode(F.array(
                F.concat(F.lit(">"), F.substring("word", F.lit(1), half)),
                F.concat(F.lit("<"), F.expr("right(word, m - int(m / 2))")))).alias("part"),
                "word", "n")
            .where(m > 0))


def edit_places(rows: DataFrame) -> DataFrame:
    """Partitions of crowded initial states: the place of the edit and all letters around it."""
    half = "int(m / 2)"
    places = F.expr(f"if(left(part, 1) = '>', sequence({half}, m), sequence(0, {half}))")
    return (rows.withColumn("j", F.explode(places))
            .withColumn("part", F.expr("concat('=', j, ':', substr(word, 1, j), ' ', "
                                       "right(word, greatest(0, m - 1 - j)))"))
            .drop("j"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, n): every word's near words and how often they occur, each pair both ways."""
    rows = cut(initial_states(words))
    crowded = cut(rows.groupBy("m", "part").count().where(F.col("count") > MOST_WORDS)
                  .select("m", "part"))
    if not crowded.isEmpty():
        rows = (rows.join(crowded, ["m", "part"], "left_anti")
                .unionByName(edit_places(rows.join(crowded, ["m", "part"], "left_semi"))))

    def compose(m: int, part: str, members: dict[str, int]) -> Iterator[tuple]:
        # what all words of the partition share is not walked again
        kind = part[0]
        if kind == "<":
            shared = len(part) - 1
            pairs = one_edit_pairs(sorted(w[:len(w) - shared] for w in members))
            pairs = {(u + part[1:], v + part[1:]) for u, v in pairs}
        else:
            head = part[1:] if kind == ">" else part.split(":", 1)[1].split(" ")[0]
            pairs = one_edit_pairs(sorted(w[len(head):] for w in members))
            pairs = {(head + u, head + v) for u, v in pairs}
        for u, v in pairs:
            if len(u) == m:
                yield u, v, members[v]
                yield v, u, members[u]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def lines():
            for frame in frames:
                yield from zip(frame["m"], frame["part"], frame["word"], frame["n"])
        found: list[tuple] = []
        for (m, part), group in groupby(lines(), key=lambda r: (r[0], r[1])):
            members = {word: n for _, _, word, n in group}
            if len(members) > 1:
                found.extend(compose(m, part, members))
            if len(found) >= 20_000:
                yield pd.DataFrame(found, columns=["word", "near", "n"])
                found = []
        yield pd.DataFrame(found, columns=["word", "near", "n"])

    return (rows.repartition("m", "part").sortWithinPartitions("m", "part")
            .mapInPandas(run, "word string, near string, n long").dropDuplicates(["word", "near"]))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form (word, form): the last one on the way of forms.

    Every round doubles the length of the way that is known.
    """
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at, before = cut(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved"))), at
        moved = not at.where("moved").isEmpty()
        at = at.drop("moved")
        if not moved:
            return at


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n)."""
    words = cut(words)
    best = (near_pairs(words).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"),
                 F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best")))
    formed = (words.join(best, "word", "left")
              .withColumn("has", F.coalesce(-F.col("best.less") >= ratio * F.col("n"), F.lit(False)))
              .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(F.col("has"), F.col("best.near")).alias("form"),
                      F.when(F.col("has"), -F.col("best.less")).alias("form_n")))
    formed = cut(formed)
    last = roots(formed.where("form is not null"))
    return (formed.join(last, "word", "left")
            .withColumn("root", F.coalesce("root", "word")))

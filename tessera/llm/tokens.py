"""Token counts with a tokenizer compiled to a finite-state transducer.

The piece vocabulary of a byte-pair tokenizer (sentencepiece models with the identity
normaliser, white space as U+2581 in front of words, byte fallback) is compiled, state by
state as texts need them, into a deterministic transducer over characters.  A transition
carries how many tokens more (or fewer) the text read so far has.

That this machine is finite rests on two facts about pair merging by rank.  The tokens of a
prefix followed by one character end in exactly one token that may follow the tokens before
it, and whether it may depends only on the last of these.  So a state needs the longest
suffix that may still become part of a token, and for each cut of that suffix the token
ending there and the count so far, relative to the end.

White space separates: no piece has it after other characters, so a word's count does not
depend on the words before it and the machine is back in one of two states at each word's
start.  A chunk of text is summed up as a map from the state before it to the state after
it with a count: the open word at its start, the count between, the open word at its end.
These maps compose associatively.  Texts longer than ``LONG`` characters are cut into chunks
whose maps are made in parallel and composed in order by a scan; the others are one chunk.

Null and empty texts have no tokens.  Special strings inside texts are ordinary characters.
Repeated rows give equal rows.  Only the key and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Longer texts (characters) are counted in chunks of CHUNK, on several tasks.
LONG, CHUNK = 1 << 20, 1 << 18
#: Words and states kept by a worker before its tables are emptied and filled anew.
WORDS_KEPT, STATES_KEPT = 400_000, 200_000


class Transducer:
    """Lazily determinised counting transducer of one model."""

    def __init__(self, model: bytes):
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size())
                      if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
        if any(SPACE in p.lstrip(SPACE) for p in self.score):
            raise ValueError("pieces with white space inside words are not supported")
        self.fallback = any(sp.is_byte(i) for i in range(sp.vocab_size()))
        self.longest = max(map(len, self.score), default=1)
        self.prefixes = {p[:n] for p in self.score for n in range(1, len(p) + 1)}
        # pieces that their own merges reach; the others never end a text
        self.reachable = {p for p in self.score if self._merge(p) == [p]}
        self.gap_period = max((len(p) for p in self.score if not p.strip(SPACE)), default=1)
        self.gaps = [len(self._merge(SPACE * k)) for k in range(4 * self.gap_period + 1)]
        self.periodic = all(self.gaps[k + self.gap_period] == self.gaps[k] + 1
                            for k in range(2 * self.gap_period, 3 * self.gap_period + 1))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = _Words(self._word)
        self._reset()

    def _reset(self) -> None:
        # a state: longest useful suffix, then per cut of it (token ending there, relative count)
        self.states: list[tuple] = [("", (("", 0),))]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def _merge(self, text: str) -> list[str]:
        """Plain pair merging of a short text: best score first, then leftmost."""
        parts = list(text)
        while True:
            best = None
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best[0]):
                    best = s, i
            if best is None:
                return parts
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def _follows(self, before: str, token: str) -> bool:
        got = self.pairs.get((before, token))
        if got is None:
            if len(self.pairs) > 4 * STATES_KEPT:
                self.pairs.clear()
            got = not before or self._merge(before + token) == [before, token]
            self.pairs[before, token] = got
        return got

    def _move(self, state: int, char: str) -> tuple[int, int]:
        """Compile one transition: (next state, change of the token count)."""
        suffix, cuts = self.states[state]
        read = suffix + char
        if char not in self.prefixes and char not in self.score:
            # nothing may contain it: its bytes (or one unknown token), then a fresh state
            token, cost, at = char, len(char.encode()) if self.fallback else 1, len(suffix)
        else:
            for n in range(min(self.longest, len(read)), 0, -1):
                token = read[-n:]
                at = len(read) - n
                if (n == 1 or token in self.reachable) and self._follows(cuts[at][0], token):
                    break  # such a token's cut is always kept
            cost = 1
            if token not in self.score:
                cost = len(token.encode()) if self.fallback else 1
        count = cuts[at][1] + cost
        keep = next((i for i in range(len(read)) if read[i:] in self.prefixes), len(read))
        read, prefixes = read[keep:], self.prefixes
        # a cut matters only while a token may still start there
        following = read, (*[(cuts[keep + i][0], cuts[keep + i][1] - count)
                             if read[i:] in prefixes else None for i in range(len(read))],
                           (token, 0))
        number = self.numbers.get(following)
        if number is None:
            number = self.numbers[following] = len(self.states)
            self.states.append(following)
            self.moves.append({})
        self.moves[state][char] = number, count
        return number, count

    def run(self, text: Iterable[str], state: int = 0) -> tuple[int, int]:
        """(state, tokens) after reading ``text``."""
        total, moves = 0, self.moves
        for char in text:
            step = moves[state].get(char) or self._move(state, char)
            state = step[0]
            total += step[1]
        return state, total

    def _word(self, word: str) -> int:
        """Tokens of one word; a leading U+2581 belongs to it."""
        if len(self.states) > STATES_KEPT:
            self._reset()
        return self.run(word)[1]

    def gap(self, k: int) -> int:
        """Tokens of ``k`` spaces in a row."""
        if k < len(self.gaps):
            return self.gaps[k]
        if not self.periodic:
            return len(self._merge(SPACE * k))
        over = -(-(k - 3 * self.gap_period) // self.gap_period)
        return self.gaps[k - over * self.gap_period] + over

    def _spaced(self, spaces: int, word: str) -> int:
        """Tokens of several spaces and the word after them."""
        own = SPACE + word
        alone = not word or not self._joins(own)
        return self.words[own] - 1 + self.gap(spaces) if alone else \
            self.words[own] + self.gap(spaces - 1)

    def _joins(self, own: str) -> bool:
        """Whether the space in front of a word merges with its first letters."""
        # the first token is settled by the characters that may share tokens with it
        return self._merge(own[:8 * self.longest])[0] != SPACE

    def count(self, text: str | None) -> int:
        """Tokens of a whole text, as one chunk or as the composition of several."""
        if not text:
            return 0
        return self.finish([self.chunk(text)])

    def chunk(self, text: str) -> tuple[str, int, str, bool]:
        """The map of a chunk: (open text at its start, tokens between, open text at its end,
        whether there is a boundary at all).  Boundaries stand before a run of spaces."""
        text = text.replace(" ", SPACE)
        first = _boundary(text)
        if first < 0:
            return text, 0, "", False
        last = _last_boundary(text)
        return text[:first], self._between(text[first:last]), text[last:], True

    def _between(self, text: str) -> int:
        """Tokens of a text that starts with spaces and ends with a word's end."""
        if not text:
            return 0
        words, total, spaces = self.words, 0, 1
        parts = text.split(SPACE)[1:]
        if "" not in parts:
            return sum([words[SPACE + p] if "\n" not in p else self._lines(SPACE + p)
                        for p in parts])
        for p in parts:
            if not p:
                spaces += 1
                continue
            head, line, rest = p.partition("\n")
            if spaces > 1:
                total += self._spaced(spaces, head)
            else:
                total += words[SPACE + head]
            if line:
                total += self._lines(line + rest)
            spaces = 1
        return total + (self.gap(spaces - 1) if spaces > 1 else 0)

    def _lines(self, text: str) -> int:
        """A word with line ends in it; nothing merges across these."""
        parts = text.split("\n")
        words = self.words
        return sum([words[p] for p in parts if p]) + (len(parts) - 1) * self._line_end

    @property
    def _line_end(self) -> int:
        return self.words["\n"]

    def finish(self, maps: Iterable[tuple[str, int, str, bool]]) -> int:
        """Scan over a text's chunk maps in order; the text starts with its own space."""
        total, open_parts = 0, [SPACE]
        for head, between, tail, split in maps:
            open_parts.append(head)
            if split:
                total += self._between_any("".join(open_parts)) + between
                open_parts = [tail]
        return total + self._between_any("".join(open_parts))

    def _between_any(self, text: str) -> int:
        if not text:
            return 0
        cut = 0 if text[0] == SPACE else len(text) if SPACE not in text else text.index(SPACE)
        return (self._lines(text[:cut]) if cut else 0) + self._between(text[cut:])


class _Words(dict):
    """Counts of words met so far, emptied when it has grown too large."""

    def __init__(self, count):
        super().__init__()
        self.of = count

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        n = self.of(word)
        if len(word) <= 64:
            self[word] = n
        return n


def _boundary(text: str) -> int:
    """First place where a run of spaces follows another character; -1 if there is none."""
    at = 0 if not text.startswith(SPACE) else len(text) - len(text.lstrip(SPACE))
    return text.find(SPACE, at) if at < len(text) else -1


def _last_boundary(text: str) -> int:
    at = len(text.rstrip(SPACE))
    if at < len(text):
        return at
    at = text.rfind(SPACE)
    return len(text[:at].rstrip(SPACE))


_COMPILED: dict[str, Transducer] = {}


def compiled(name: str, model) -> Transducer:
    """The worker's transducer of a broadcast model, kept from one task to the next."""
    if name not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[name] = Transducer(model.value)
    return _COMPILED[name]


def count_tokens(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text",
                 long: int = LONG, chunk: int = CHUNK) -> DataFrame:
    """(key, n_bytes, n_tokens) of every row.  ``model`` is the tokenizer file's content."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one file of fixed size
    name = hashlib.sha256(model).hexdigest()

    def machine() -> Transducer:
        return compiled(name, sent)

    @F.pandas_udf("long")
    def whole(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = machine()
        for texts in batches:
            yield pd.Series([m.count(t) for t in texts], dtype="int64")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for mark, t in zip(frame["mark"], frame["text"]):
                for n, i in enumerate(range(0, len(t), chunk)):
                    yield pd.DataFrame({"mark": [mark], "n": [n], "piece": [t[i:i + chunk]]})

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = machine()
        for frame in batches:
            made = [m.chunk(p) for p in frame["piece"]]
            yield pd.concat([frame[["mark", "n"]].reset_index(drop=True), pd.DataFrame(
                made, columns=["head", "between", "tail", "split"])], axis=1)

    @F.pandas_udf("long")
    def scan(lists: pd.Series) -> pd.Series:
        m = machine()
        return pd.Series([m.finish((x["head"], x["between"], x["tail"], x["split"])
                                   for x in sorted(rows, key=lambda x: x["n"]))
                          for rows in lists], dtype="int64")

    size: Column = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")
    is_long = F.coalesce(F.char_length(F.col(text)) > long, F.lit(False))
    short_rows = docs.where(~is_long).select(
        F.col(key).alias(key), size.alias("n_bytes"), whole(F.col(text)).alias("n_tokens"))
    long_rows = docs.where(is_long).select(
        F.col(key).alias(key), size.alias("n_bytes"), F.sha2(F.col(text), 256).alias("mark"),
        F.col(text).alias("text"))
    pieces = (long_rows.select("mark", "text").mapInPandas(cut, "mark string, n long, piece string")
              .repartition("mark", "n"))
    counted = (pieces.mapInPandas(
        maps, "mark string, n long, head string, between long, tail string, split boolean")
        # equal texts give equal chunks, so one of each is enough
        .dropDuplicates(["mark", "n"])
        .groupBy("mark").agg(F.collect_list(F.struct("n", "head", "between", "tail", "split"))
                             .alias("rows"))
        .select("mark", scan("rows").alias("n_tokens")))
    return short_rows.unionByName(long_rows.drop("text").join(counted, "mark").drop("mark"))

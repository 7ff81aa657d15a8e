"""BPE encoding and decoding by speculate and verify.

The vocabulary is a byte-level BPE with word ends (``</w>``): NFC, white space runs to one
space, lower case, words by a fixed pattern, each word's bytes as printable symbols, merges by
rank.  For each distinct word of a batch:

1. speculate: greedy longest match over the vocabulary proposes tokens;
2. verify: every adjacent pair of proposed tokens (and every lone token) is looked up in a
   table of pairs known to be compatible, for all words of the batch at once.  A
   pair is compatible when merging the pair's joined symbols gives back that pair.
   A proposal whose adjacent pairs are all compatible is what merging would give;
3. repair: only words with a failing pair are merged exactly.

Unknown pairs are decided by merging those few symbols once and remembered.  Merging, of pairs as of failing words,
is done for a whole batch at once: per round every word takes its next merge, the lowest rank and the leftmost
of equal ones.  Word results and pair verdicts are kept per Python worker in tables that are emptied at a fixed number of
entries, so memory is bounded; results do not depend on them.

Special tokens written out in a text are found first and get their own ids.  Decoding joins the
tokens of the ids with one space, special ones too, as a vocabulary without a decoder does.

Defined results: a null text is empty; an empty text has no ids and decodes to an empty text;
symbols outside the vocabulary are dropped; repeated rows are encoded each; the vocabulary
file's path is a parameter and the file is broadcast (it is read on the driver).
"""

from __future__ import annotations

import contextlib
import functools
import gc
import hashlib
import itertools
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import ship, tidy

#: Fixed value: the vocabulary file's word pattern.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same pattern for lower-cased texts within Latin-1, its classes written out.
_L, _N, _W = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\\x09-\\x0d\\x20\x85\xa0"
LATIN_WORD_PATTERN = f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_W}{_L}{_N}]+"
WORD_END = "</w>"
MAX_WORDS = 100_000
MAX_PAIRS = 2_000_000
#: New words that are verified and merged together.
WORDS_AT_ONCE = 16_384
#: Words longer than this many bytes are not kept in the worker's table.
MAX_KEPT_WORD = 64
#: Words of up to so many symbols are merged together; longer ones each with a heap.  Both merge alike.
SHORT_WORD = 64
NO_RANK = 1 << 60
#: Texts are encoded together up to so many characters.
CHUNK_CHARS = 1_000_000


@functools.cache
def byte_symbols() -> dict[int, str]:
    """The printable symbol of each byte: printable Latin-1 bytes stand for themselves, the
    others follow from code point 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class Vocabulary:
    """The file's tables: ids, merges by pair of ids, special tokens, longest token by first two symbols."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()}
        self.merges: dict[int, tuple[int, int]] = {}  # left id << 32 | right id -> rank, id of both
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            self.merges[self.ids[left] << 32 | self.ids[right]] = (rank, self.ids[left + right])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.prefixes = ahocorasick.Automaton()
        for t in self.ids:
            self.prefixes.add_word(t, True)
        self.decimal = {i: str(i) for i in self.tokens}
        # the same tables as arrays: merges sorted by pair, and every token's symbols
        self.pairs = np.array(sorted(self.merges), dtype=np.int64)
        self.ranks = np.array([self.merges[p][0] for p in self.pairs.tolist()], dtype=np.int64)
        self.merged = np.array([self.merges[p][1] for p in self.pairs.tolist()], dtype=np.int64)
        parts = [self.symbols(self.tokens.get(i, "")) for i in range(max(self.tokens) + 1)]
        self.part_count = np.array(list(map(len, parts)), dtype=np.int64)
        self.part_start = np.concatenate([[0], np.cumsum(self.part_count)])
        self.parts = np.array([x for p in parts for x in p], dtype=np.int64)
        self.inner = np.array([self.ids.get(chr(c), -1) for c in range(512)], dtype=np.int64)  # byte symbols are below 512
        self.final = np.array([self.ids.get(chr(c) + WORD_END, -1) for c in range(512)], dtype=np.int64)
        self.ends = np.array([self.tokens.get(i, "").endswith(WORD_END) for i in range(len(parts))], dtype=bool)

    def propose(self, word: str) -> list[int] | None:
        """Greedy longest match over a word's byte symbols with their end; None where a symbol is in no token."""
        ids, reach, out, i, n = self.ids, self.prefixes.longest_prefix, [], 0, len(word)
        while i < n:
            j = i + reach(word[i:])  # no token goes on beyond; one that ends within the word's end does not count
            while j > i and ((k := ids.get(word[i:j])) is None or n > j >= n - len(WORD_END)):
                j -= 1
            if j == i:
                return None
            out.append(k)
            i = j
        return out

    def symbols(self, token: str) -> list[int]:
        """Ids of a token's single symbols; the last one carries the word end if the token does."""
        end = token.endswith(WORD_END) and len(token) > len(WORD_END)
        bare = token[:-len(WORD_END)] if end else token
        parts = [*bare[:-1], bare[-1] + WORD_END] if end else list(bare)
        return [k for x in parts if (k := self.ids.get(x)) is not None]

    def symbols_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the byte symbols of words, one after the other, and how many each word has; unknown symbols are dropped."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-16-le"), dtype="<u2")
        flat = self.inner[code]
        flat[np.cumsum(length) - 1] = self.final[code[np.cumsum(length) - 1]]
        known = flat >= 0
        if not known.all():
            length = np.bincount(np.repeat(np.arange(len(words)), length)[known], minlength=len(words))
            flat = flat[known]
        return flat, length

    def merge_all(self, flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: ``flat`` holds their symbols one after the other.

        A round does each word's next merge: the lowest rank, the leftmost of equal ones.  Words
        without one are done and leave the working arrays.
        """
        out, count = flat.copy(), length.copy()
        start = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else np.empty(0, np.int64)
        word = np.repeat(np.arange(len(length)), length)
        symbol = flat.astype(np.int64)

        def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Rank and result of the pairs that begin at these places."""
            rank, to = np.full(len(at), NO_RANK, dtype=np.int64), np.full(len(at), -1, dtype=np.int64)
            inner = np.flatnonzero(at + 1 < len(word))
            inner = inner[word[at[inner]] == word[at[inner] + 1]]
            pair = symbol[at[inner]] << 32 | symbol[at[inner] + 1]
            place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            hit = self.pairs[place] == pair
            rank[inner[hit]], to[inner[hit]] = self.ranks[place[hit]], self.merged[place[hit]]
            return rank, to

        rank, to = look(np.arange(len(symbol)))
        while len(symbol):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))  # of words that have symbols
            least = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(symbol)))
            going = least < NO_RANK
            if not going.all():
                stays = np.repeat(going, size)
                done = ~stays
                names = word[first][~going]
                n = size[~going]
                count[names] = n
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                out[np.repeat(start[names], n) + within] = symbol[done]
                symbol, word, rank, to = symbol[stays], word[stays], rank[stays], to[stays]
                size, least = size[going], least[going]
                if not len(symbol):
                    break
            lowest = np.flatnonzero(rank == np.repeat(least, size))
            of = word[lowest]
            place = lowest[np.concatenate([[True], of[1:] != of[:-1]])]
            symbol[place] = to[place]
            stays = np.ones(len(symbol), dtype=bool)
            stays[place + 1] = False
            symbol, word, rank, to = symbol[stays], word[stays], rank[stays], to[stays]
            place = place - np.arange(len(place))  # one symbol went before each later place
            before = place[place > 0] - 1
            again = np.concatenate([place, before])
            rank[again], to[again] = look(again)
        return out[np.repeat(start, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)], count

    def merge(self, part: list[int]) -> list[int]:
        """Exact merging of one word."""
        return self._heap(part)

    def _heap(self, part: list[int]) -> list[int]:
        n = len(part)
        part, after, before = list(part), list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := self.merges.get(part[i] << 32 | part[j])):
                heapq.heappush(heap, (m[0], i, part[i] << 32 | part[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = after[i]
            if part[i] < 0 or j >= n or part[i] << 32 | part[j] != pair:
                continue  # an older state of the list
            part[i], part[j] = self.merges[pair][1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in part if p >= 0]


class Encoder:
    """Encodes words in batches; holds a worker's tables."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.split = regex.compile(WORD_PATTERN)
        self.split_latin = re.compile(LATIN_WORD_PATTERN).findall
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))) \
            if vocabulary.special else None
        self.words: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}
        self.known = np.empty(0, dtype=np.int64)   # pairs with a verdict, sorted
        self.fits = np.empty(0, dtype=bool)
        self.failed = 0

    def forget(self) -> None:
        """Empty the tables of words, so that an idle worker holds the vocabulary only."""
        self.words, self.older = {}, {}

    def pair_verdicts(self, pairs: np.ndarray) -> np.ndarray:
        """Compatible or not, for packed pairs (left id * 2^32 + right id; a lone token's left is -1)."""
        need = np.unique(pairs)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, need), len(self.known) - 1)
            need = need[self.known[at] != need]
        if len(need):
            fits = self._compatible(need >> 32, need & 0xFFFFFFFF)
            if len(self.known) + len(need) > MAX_PAIRS:
                self.known, self.fits = np.empty(0, dtype=np.int64), np.empty(0, dtype=bool)
                return self.pair_verdicts(pairs) if len(need) < MAX_PAIRS else self._direct(pairs, need, fits)
            known = np.concatenate([self.known, need])
            order = np.argsort(known)
            self.known, self.fits = known[order], np.concatenate([self.fits, fits])[order]
        return self.fits[np.searchsorted(self.known, pairs)]

    @staticmethod
    def _direct(pairs, need, fits):
        return fits[np.searchsorted(need, pairs)]

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of both tokens (of the right one where left is -1) gives back both."""
        v, lone = self.v, left < 0
        own = np.where(lone, 0, v.part_count[np.maximum(left, 0)])
        both = np.column_stack([own, v.part_count[right]]).ravel()
        begin = np.column_stack([v.part_start[np.maximum(left, 0)], v.part_start[right]]).ravel()
        flat = v.parts[np.repeat(begin, both) + np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)]
        out, count = v.merge_all(flat, own + v.part_count[right])
        last = np.cumsum(count)
        good = (count == np.where(lone, 1, 2)) & (lone | ~v.ends[np.maximum(left, 0)])
        good[good] = out[last[good] - 1] == right[good]
        pair = good & ~lone
        good[pair] = out[last[pair] - 2] == left[pair]
        return good

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words, verified together."""
        table = byte_symbols()
        cut = [w.encode("utf-8").decode("latin-1").translate(table) for w in words]
        proposals = [self.v.propose(s + WORD_END) for s in cut]
        ids = [p or [] for p in proposals]
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for p in ids for i in p), np.int64, int(length.sum()))
        word = np.repeat(np.arange(len(ids)), length)
        left = np.empty_like(flat)
        if len(flat):
            left[1:], left[0] = flat[:-1], -1
            first = np.concatenate([[True], word[1:] != word[:-1]])
            lone = first & (length[word] == 1)
            asked = ~first | lone
            pairs = (np.where(lone, np.int64(-1), left) << 32) | flat
            good = np.ones(len(flat), dtype=bool)
            good[asked] = self.pair_verdicts(pairs[asked])
            bad = np.zeros(len(ids), dtype=bool)
            bad[word[~good]] = True
        else:
            bad = np.zeros(len(ids), dtype=bool)
        failing = [i for i, p in enumerate(proposals) if p is None or bad[i]]
        self.failed += len(failing)
        short = [i for i in failing if len(cut[i]) <= SHORT_WORD]
        flat, count = self.v.merge_all(*self.v.symbols_of([cut[i] for i in short]))
        merged, end = flat.tolist(), np.cumsum(count).tolist()
        for i, n, to in zip(short, count.tolist(), end):
            ids[i] = merged[to - n:to]
        for i in failing:
            if len(cut[i]) > SHORT_WORD:
                ids[i] = self.v.merge(self.v.symbols(cut[i] + WORD_END))
        return ids

    def pieces(self, text: str) -> list[str]:
        """A text's words; special tokens appear as they are written."""
        if self.special is None or not any(s in text for s in self.v.special):
            return self._words(text)
        out, at = [], 0
        for m in self.special.finditer(text):
            out += self._words(text[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        """Normalise and split.  White space is in no word, so its runs need no folding first."""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.replace("\u03a3", "\u03c3").lower()  # letters are lowered one by one: no final form of sigma
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.split.findall(text)
        return self.split_latin(text)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Per text: number of ids, ids joined by one space, decoded text."""
        for some in runs(texts):
            chunk = [self.pieces(t) if t else [] for t in some]
            table = self._table(set().union(*chunk))
            for words in chunk:
                n, ids, decoded = zip(*map(table.__getitem__, words)) if words else ((), (), ())
                if 0 in n:  # words without a known symbol
                    ids, decoded = [x for x, k in zip(ids, n) if k], [x for x, k in zip(decoded, n) if k]
                yield sum(n), " ".join(ids), " ".join(decoded)

    def _table(self, words: set[str]) -> dict[str, tuple[int, str, str]]:
        """Entries of the given words: number of ids, the ids, their decoding.  Two generations of
        entries are kept; what is asked for is in the younger one afterwards."""
        entries, fresh, young, older, special = {}, [], self.words, self.older, self.v.special
        kept = {}  # what the younger generation lacks
        for w in words:
            if (e := young.get(w)) is not None:
                entries[w] = e
            elif (e := older.get(w)) is not None:
                entries[w] = kept[w] = e
            elif w not in special:
                fresh.append(w)
        number, token = self.v.decimal.__getitem__, self.v.tokens.__getitem__
        slices = (fresh[k:k + WORDS_AT_ONCE] for k in range(0, len(fresh), WORDS_AT_ONCE))
        encoded = itertools.chain.from_iterable(zip(some, self.encode_words(some)) for some in slices)
        for w, i in itertools.chain(encoded, ((w, [special[w]]) for w in words if w in special)):
            e = entries[w] = (len(i), " ".join(map(number, i)), " ".join(map(token, i)))
            if len(w) <= MAX_KEPT_WORD:
                kept[w] = e
        if len(young) + len(kept) > MAX_WORDS:
            self.older, self.words = young, {}
        self.words.update(kept)
        return entries


def runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in runs of about ``CHUNK_CHARS`` characters; each run is encoded together."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < CHUNK_CHARS):
            size += len(texts[end] or "")
            end += 1
        yield texts[at:end]
        at = end


@contextlib.contextmanager
def without_collector() -> Iterator[None]:
    """Encoding makes no reference cycles; the collector would only walk the worker's tables again and again."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def load(path: str) -> str:
    """The vocabulary file's text, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary: str, text: str = "text", digests_only: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``n_tokens``, ``ids`` (decimal, joined by one space) and ``decoded``; with
    ``digests_only`` the SHA-256 of the two texts instead (``ids_sha256``, ``decoded_sha256``).

    ``vocabulary``: the file's text (see ``load``), broadcast to the executors.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    names = ("ids_sha256", "decoded_sha256") if digests_only else ("ids", "decoded")

    @F.pandas_udf(", ".join(["n_tokens long", *(f"{c} string" for c in names)]))
    @tidy
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = worker_encoder(shared.value)
        yield from frames(encoder, parts, names, digests_only)
        encoder.forget()

    others = [c for c in docs.columns if c not in ("n_tokens", *names)]
    return (docs.withColumn("__bpe", run(F.col(text)))
            .select(*[F.col(f"`{c}`") for c in others], *[F.col(f"__bpe.{c}").alias(c) for c in ("n_tokens", *names)]))


def frames(encoder: Encoder, parts: Iterator[pd.Series], names: tuple[str, str], digests_only: bool) -> Iterator[pd.DataFrame]:
    """A task's results, one frame for each run of texts: ids and decoding are some four times as long as the text, and
    a whole batch of them would be held as strings, in Arrow's buffers and by the JVM at the same time."""
    sha = lambda s: hashlib.sha256(s.encode("utf-8")).hexdigest()
    for texts in parts:
        for some in runs(texts.tolist()):
            with without_collector():
                columns: list[list] = [[] for _ in range(1 + len(names))]
                for row in encoder.encode(some):
                    for column, x in zip(columns, row):
                        column.append(sha(x) if digests_only and column is not columns[0] else x)
                frame = pd.DataFrame(dict(zip(["n_tokens", *names], columns)))
                del columns
            yield frame


@functools.lru_cache(maxsize=1)
def worker_encoder(text: str) -> Encoder:
    """One encoder per Python worker, kept between tasks."""
    return Encoder(Vocabulary(text))

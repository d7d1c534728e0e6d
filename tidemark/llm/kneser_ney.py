"""Loss of texts under the whole modified Kneser-Ney trigram model of their language.

Every word of every text is a token of its own and every n-gram is kept, whatever its count: nothing of the
model's size is broadcast, collected or held by one task. Occurrences within the same six words count once.

Words travel as 64-bit hashes that hold their language. A task sorts the trigrams of a block of texts and sends
them, packed in columns, to the bucket of their middle word, where a bucket sees all that follows a word and all
that precedes it; middle words with more than a share of a bucket are dealt out by the word before them (`salts`).

1. Count: per bucket the distinct contexts of each trigram, the trigrams counted more than once, and the pairs
   (middle, last word) with the number of words before them.
2. Totals: pairs of dealt-out words, and words over the pairs they end, are added up by key; each bucket gets the
   totals of the keys it asked for, in the order it asked. Pairs themselves are not kept.
3. Score: the trigrams of every text go to their bucket once more with the texts that hold them; a bucket makes the
   probabilities of its trigrams from them and the totals and returns the losses it found, added up by text.

1 and 3 run in slices of the buckets, one after the other, so that the disk holds one slice of what is shuffled.
The most frequent words travel as codes of two bytes. That, salts and slices decide where and how a row travels and
nothing else. What one task must hold is a bucket, or all that one pair of words begins if that is more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import ascending, distinct, mix, word_bounds, word_hashes
from tidemark.workspace import Workspace

# Rows between the steps: a bucket, what the blob holds, where it comes from.
_ROWS = "bucket long, kind int, src long, blob binary"
_ARROW = pa.schema([("bucket", pa.int64()), ("kind", pa.int32()), ("src", pa.int64()), ("blob", pa.binary())])
_STATS, _MANY, _HOT, _HOT_WORD, _GRAMS, _HEADER, _SUMS = range(7)
_ASK_COLD, _ASK_HOT, _ASK_PAIRS = 10, 11, 12  # words of pairs that are, and are not, all in one bucket; the latter pairs
_ANSWER = 10  # added to the kind of what was asked
_GOLD = 0x9E3779B97F4A7C15
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SLOT_BITS = 20
_HEADERS = 64  # groups of rows that pass a bucket step unread


@dataclass(frozen=True)
class SweepParams:
    """How the work is cut up; no result depends on it."""

    bucket_words: int = 1 << 19
    piece_bytes: int = 1 << 19  # of text, whose words are hashed at once
    block_words: int = 1 << 20  # sorted and sent at once
    slice_words: int = 1 << 22
    count_slices: int = 4
    score_slices: int = 3
    codes: int = 65_535
    code_share: float = 2.0**-18


# --- packing

_KINDS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}


def _packed(*arrays: np.ndarray) -> bytes:
    """The arrays' bytes behind one another, compressed."""
    head = np.array([len(arrays), *(a.size * 16 + a.itemsize for a in arrays)], np.int64)
    data = b"".join((head.tobytes(), *(a.tobytes() for a in arrays)))
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    view = memoryview(blob)
    data = pa.Codec("zstd").decompress(view[8:], int.from_bytes(view[:8], "little"), asbytes=True)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    out, at = [], 8 * (n + 1)
    for size in np.frombuffer(data, np.int64, n, 8).tolist():
        out.append(np.frombuffer(data, _KINDS[size % 16], size // 16, at))
        at += (size // 16) * (size % 16)
    return out


def _small(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes, those of 255 and more beside them."""
    return np.minimum(values, 255).astype(np.uint8), values[values >= 255].astype(np.uint64)


def _whole(small: np.ndarray, rest: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[small == 255] = rest.astype(np.int64)
    return out


def _steps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def _joined(parts: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _batch(rows: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _table(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _by_kind(rows: pa.Table) -> dict[int, list[tuple[int, bytes]]]:
    """(src, blob) of each kind."""
    out: dict[int, list[tuple[int, bytes]]] = {}
    for kind, src, blob in zip(rows["kind"].to_pylist(), rows["src"].to_pylist(), rows["blob"].to_pylist()):
        out.setdefault(kind, []).append((src, blob))
    return out


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, end) of each run."""
    values, starts = np.unique(sorted_values, return_index=True)
    yield from zip(values.tolist(), starts.tolist(), [*starts[1:].tolist(), len(sorted_values)])


# --- the corpus as all tasks know it


def gram(u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(mix(u) * _GOLD + v) * _GOLD + w)


def pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(mix(v + 1) * _GOLD + w)


class Corpus:
    """Buckets of each language; codes of frequent words and the number of buckets a frequent middle word is dealt to."""

    def __init__(self, totals: dict[str, int], p: SweepParams):
        self.p = p
        self.names = sorted(totals)
        sizes = np.array([max(1, -(-totals[lang] // p.bucket_words)) for lang in self.names], np.int64)
        self.sizes, self.bases = sizes.astype(np.uint64), (np.cumsum(sizes) - sizes).astype(np.uint64)
        self.n_buckets = int(sizes.sum())
        self.index = {lang: k for k, lang in enumerate(self.names)}
        seed = lambda lang: int.from_bytes(
            hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        self.seeds = np.array([seed(lang) for lang in self.names], np.uint64)
        self.starts = mix(self.seeds ^ np.uint64(_GOLD))  # the token before a text
        self.most_slices = max(1, -(-sum(totals.values()) // p.slice_words))
        self.name_words(np.empty(0, np.uint64), np.empty(0, np.int64))

    def name_words(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        """Give the tokens, most frequent first, their codes."""
        slot = (tokens >> (64 - _SLOT_BITS)).astype(np.int64)
        first = np.sort(np.unique(slot, return_index=True)[1])[: self.p.codes]
        tokens, slot = tokens[first], slot[first]
        self.long = np.concatenate((np.zeros(1, np.uint64), tokens))
        self.salts = np.concatenate((np.ones(1, np.int64), np.maximum(1, 4 * counts[first] // self.p.bucket_words)))
        self._place()

    def _place(self) -> None:
        slot = (self.long[1:] >> (64 - _SLOT_BITS)).astype(np.int64)
        self.slot_token, self.slot_code = np.zeros(1 << _SLOT_BITS, np.uint64), np.zeros(1 << _SLOT_BITS, np.uint16)
        self.slot_token[slot], self.slot_code[slot] = self.long[1:], np.arange(1, len(self.long))
        # By the first 16 bits of a token: may it be dealt out?
        self.maybe_hot = np.zeros(1 << 16, bool)
        self.maybe_hot[(self.long[self.salts > 1] >> 48).astype(np.int64)] = True

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("slot_token", "slot_code", "maybe_hot")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._place()

    def codes(self, tokens: np.ndarray) -> np.ndarray:
        slot = (tokens >> (64 - _SLOT_BITS)).astype(np.int64)
        return np.where(self.slot_token[slot] == tokens, self.slot_code[slot], 0).astype(np.uint16)

    def short(self, tokens: np.ndarray, codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        codes = self.codes(tokens) if codes is None else codes
        return codes, tokens[codes == 0]

    def tokens(self, codes: np.ndarray, rest: np.ndarray) -> np.ndarray:
        out = self.long[codes]
        out[codes == 0] = rest
        return out

    def spread(self, lang: int, keys: np.ndarray) -> np.ndarray:
        """Bucket of a key among those of its language, ascending with the key."""
        return (self.bases[lang] + ((keys >> 32) * self.sizes[lang] >> 32)).astype(np.int64)

    def lang(self, bucket: int) -> int:
        return int(np.searchsorted(self.bases, bucket, "right")) - 1

    def dealt(self, tokens: np.ndarray) -> np.ndarray:
        """To how many buckets each middle word is dealt."""
        out = np.ones(len(tokens), np.int64)
        maybe = np.flatnonzero(self.maybe_hot[(tokens >> 48).astype(np.int64)])
        out[maybe] = self.salts[self.codes(tokens[maybe])]
        return out


class Piece:
    """The words of some texts with the two words before each."""

    def __init__(self, corpus: Corpus, langs: list[int], texts: list[bytes]):
        ends = np.cumsum([len(t) + 1 for t in texts])
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, stops = word_bounds(raw)
        at = np.searchsorted(starts, ends)
        n = np.diff(at, prepend=0)
        self.n_docs, self.doc = len(texts), np.repeat(np.arange(len(texts)), n)
        each = lambda values: np.repeat(values[np.array(langs)], n)
        self.w = mix(word_hashes(raw, starts, stops) + each(corpus.seeds))
        start = corpus.starts[np.array(langs)]
        self.v, self.u = np.roll(self.w, 1), np.roll(self.w, 2)
        for place, held in ((at - n, n > 0), (at - n + 1, n > 1)):
            self.u[place[held]] = start[held]
        self.v[(at - n)[n > 0]] = start[n > 0]
        salts = corpus.dealt(self.v).astype(np.uint64)
        salt = (self.u >> 32) * salts >> 32
        self.bucket = (each(corpus.bases) + ((mix(self.v + salt * _GOLD) >> 32) * each(corpus.sizes) >> 32)).astype(np.int64)

    def contexts(self, chosen: np.ndarray) -> np.ndarray:
        """Per chosen word a hash of the three words before it, itself and the two behind it."""
        at = np.arange(len(self.doc)) + 3 * self.doc
        wide = np.zeros(len(self.doc) + 3 * self.n_docs + 3, np.uint64)
        wide[at + 3] = self.w
        at, run = at[chosen], np.zeros(len(chosen), np.uint64)
        for k in range(6):
            run = mix(run + wide[at + k]) * _GOLD
        return mix(run)


def _pieces(corpus: Corpus, batches, seen: set | None) -> Iterator[tuple[Piece, list[bytes]]]:
    """Pieces with the digests of their texts; a text whose digest is in `seen` already is left out."""
    langs, texts, digests, size = [], [], [], 0
    for batch in batches:
        for lang, text, digest in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if lang not in corpus.index or seen is not None and digest in seen:
                continue
            if seen is not None:
                seen.add(digest)
            langs.append(corpus.index[lang])
            texts.append(text)
            digests.append(digest)
            size += len(text) + 1
            if size >= corpus.p.piece_bytes:
                yield Piece(corpus, langs, texts), digests
                langs, texts, digests, size = [], [], [], 0
    if texts:
        yield Piece(corpus, langs, texts), digests


def _by_place(bucket: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Order by bucket, then by middle word, which packs best."""
    return ascending(bucket.astype(np.uint64) << 22 | v >> 42)


def _sliced(piece: Piece, k: int, slices: int) -> np.ndarray:
    return np.arange(len(piece.doc)) if slices == 1 else np.flatnonzero(piece.bucket % slices == k)


# --- the steps


def _frequent(shared):
    """Words and starts of a text with their number in a block of texts, if they are a good share of it."""

    def scan(batches):
        corpus, found, size = shared.value, [], 0

        def made():
            tokens, _, _, n = distinct(np.concatenate(found))
            kept = n >= max(4, size * corpus.p.code_share)
            return pa.RecordBatch.from_pydict({"token": tokens[kept].view(np.int64), "n": (n[kept] + 1) // 2})

        for piece, _ in _pieces(corpus, batches, None):
            found += [piece.v, piece.w]
            size += 2 * len(piece.w)
            if size >= 2 * corpus.p.block_words:
                yield made()
                found, size = [], 0
        if found:
            yield made()

    return scan


def _counted(shared, k: int, slices: int):
    """mapInArrow function: the trigrams of a slice of the buckets, each with the rest of its context."""

    def scan(batches):
        corpus, src = shared.value, TaskContext.get().partitionId()

        def made():
            bucket, v, u, w, contexts = (np.concatenate(x) for x in zip(*found))
            first = distinct(contexts)[1]
            order = first[_by_place(bucket[first], v[first])]
            bucket, v, u, w, contexts = (x[order] for x in (bucket, v, u, w, contexts))
            parts = (*_columns(corpus, v, u, w), contexts.astype(np.uint32), (contexts >> 32).astype(np.uint16))
            return _batch([(to, _GRAMS, src, _cut(parts, corpus, i, j)) for to, i, j in _runs(bucket)])

        found, size = [], 0
        for piece, _ in _pieces(corpus, batches, None):
            chosen = _sliced(piece, k, slices)
            found.append((piece.bucket[chosen], piece.v[chosen], piece.u[chosen], piece.w[chosen], piece.contexts(chosen)))
            size += len(chosen)
            if size >= corpus.p.block_words:
                yield made()
                found, size = [], 0
        if size:
            yield made()

    return scan


def _columns(corpus: Corpus, *words: np.ndarray) -> tuple:
    """Words with their codes."""
    return tuple((x, corpus.codes(x)) for x in words)


def _cut(parts: tuple, corpus: Corpus, i: int, j: int, *more: np.ndarray) -> bytes:
    """Rows i to j of columns, words as codes and the words without one."""
    out = []
    for x in parts:
        out += corpus.short(x[0][i:j], x[1][i:j]) if isinstance(x, tuple) else [x[i:j]]
    return _packed(*out, *more)


def _grams(corpus: Corpus, blobs: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """v, u, w of all blobs."""
    return tuple(_joined([corpus.tokens(b[k], b[k + 1]) for b in blobs]) for k in (0, 2, 4))


def _count(shared):
    def count(rows: pa.Table) -> pa.Table:
        corpus, bucket = shared.value, rows["bucket"][0].as_py()
        blobs = [_unpacked(b) for b in rows["blob"].to_pylist()]
        v, u, w = _grams(corpus, blobs)
        contexts = _joined([b[6].astype(np.uint64) | b[7].astype(np.uint64) << 32 for b in blobs])
        del blobs
        grams = gram(u, v, w)
        first = distinct(mix(grams + contexts * _GOLD))[1]
        grams, at, _, n = distinct(grams[first])
        at = first[at]
        v, w = v[at], w[at]
        _, at, _, before = distinct(pair(v, w))
        v, w = v[at], w[at]
        hot = corpus.dealt(v) > 1
        many = n > 1
        words, _, _, ended = distinct(w[~hot])
        out = [(bucket, _STATS, 3, _packed(_tally(n))), (bucket, _STATS, 2, _packed(_tally(before[~hot]))),
               (bucket, _MANY, 0, _packed(_steps(grams[many]), *_small(n[many]))),
               *_asked(corpus, bucket, _ASK_COLD, words, ended)]
        if hot.any():
            out.append((bucket, _HOT, 0, _packed(*corpus.short(v[hot]), *corpus.short(w[hot]), *_small(before[hot]))))
        return _table(out)

    return count


def _tally(n: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, 3 and 4; how many there are; their sum."""
    return np.array([*((n == k).sum() for k in (1, 2, 3, 4)), (n > 0).sum(), n.sum()], np.uint64)


def _asked(corpus: Corpus, bucket: int, kind: int, keys: np.ndarray, n: np.ndarray) -> list:
    """Rows that ask for the totals of ascending keys."""
    owner = corpus.spread(corpus.lang(bucket), keys)
    return [(to, kind, bucket, _packed(_steps(keys[i:j]), *_small(n[i:j]))) for to, i, j in _runs(owner)]


def _hot_pairs(corpus: Corpus, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    b = _unpacked(blob)
    return corpus.tokens(b[0], b[1]), corpus.tokens(b[2], b[3]), _whole(b[4], b[5])


def _ask_pairs(shared):
    def ask(batches):
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("blob").to_pylist()):
                v, w, before = _hot_pairs(shared.value, blob)
                yield _batch(_asked(shared.value, bucket, _ASK_PAIRS, pair(v, w), before))

    return ask


def _totals(rows: pa.Table) -> pa.Table:
    """Per asked key the total over all that ask for it, and whether this is its first mention."""
    bucket, asked = rows["bucket"][0].as_py(), list(zip(rows["src"].to_pylist(), rows["kind"].to_pylist()))
    blobs = [_unpacked(b) for b in rows["blob"].to_pylist()]
    keys = [np.cumsum(b[0]) for b in blobs]
    _, first, which, _ = distinct(_joined(keys))
    sums = np.bincount(which, _joined([_whole(b[1], b[2]) for b in blobs]), len(first)).astype(np.int64)
    leads = np.zeros(len(which), np.uint8)
    leads[first] = 1
    out, at = [(bucket, _STATS, 1, _packed(_tally(sums)))], 0
    for (src, kind), part in zip(asked, keys):
        here = slice(at, at + len(part))
        out.append((src, kind + _ANSWER, bucket, _packed(*_small(sums[which[here]]), leads[here])))
        at += len(part)
    return _table(out)


def _answers(parts: dict[int, list[tuple[int, bytes]]], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Totals and first mentions in the order of the keys: owners ascend with the keys they own."""
    blobs = [_unpacked(blob) for _, blob in sorted(parts.get(kind + _ANSWER, []), key=lambda part: part[0])]
    return (_joined([_whole(b[0], b[1]) for b in blobs], np.int64), _joined([b[2] for b in blobs], np.uint8) == 1)


def _ask_words(shared):
    """Of pairs with dealt-out words, each counted where it is mentioned first."""

    def ask(rows: pa.Table) -> pa.Table:
        corpus, bucket, parts = shared.value, rows["bucket"][0].as_py(), _by_kind(rows)
        v, w, _ = _hot_pairs(corpus, parts[_HOT][0][1])
        before, leads = _answers(parts, _ASK_PAIRS)
        words, _, which, _ = distinct(w)
        out = _asked(corpus, bucket, _ASK_HOT, words, np.bincount(which, leads, len(words)).astype(np.int64))
        out.append((bucket, _STATS, 2, _packed(_tally(before[leads]))))
        for word in np.unique(v[leads]):
            out.append((bucket, _HOT_WORD, int(word.view(np.int64)), _packed(_tally(before[leads & (v == word)]))))
        return _table(out)

    return ask


# --- probabilities


def discounts(tally: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts of a count of 0, 1, 2, 3 and more."""
    n1, n2, n3, n4 = (float(x) for x in tally[:4])
    y = n1 / (n1 + 2 * n2) if n1 + 2 * n2 else None
    step = lambda k, a, b: 0.5 * k if y is None or not a else min(max(k - (k + 1) * y * b / a, 0.0), float(k))
    return np.array([0.0, step(1, n1, n2), step(2, n2, n3), step(3, n3, n4)])


def _taken(tally: np.ndarray, steps: np.ndarray) -> float:
    """Sum of the discounts of the tallied counts."""
    return float(steps[1] * tally[0] + steps[2] * tally[1] + steps[3] * (float(tally[4]) - float(tally[0]) - float(tally[1])))


class Rates:
    """Per language the discounts of the three orders and the tally of words; what follows dealt-out words."""

    def __init__(self, tallies: np.ndarray, hot: dict[int, np.ndarray], corpus: Corpus):
        self.steps = [[discounts(t) for t in tallies[order]] for order in range(3)]
        self.words = tallies[0]
        words = np.array(sorted(hot), np.uint64)
        lang_of = np.zeros(len(words), np.int64)
        self.hot, self.hot_sum, self.hot_taken = words, np.zeros(len(words)), np.zeros(len(words))
        for k, word in enumerate(words.tolist()):
            lang_of[k], tally = hot[word]
            self.hot_sum[k], self.hot_taken[k] = float(tally[5]), _taken(tally, self.steps[1][lang_of[k]])


def _level(n: np.ndarray, key: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per key the sum of its counts and of their discounts; per count its key's place and its discount."""
    keys, _, which, _ = distinct(key)
    taken = steps[np.minimum(n, 3)]
    return np.bincount(which, n, len(keys)), np.bincount(which, taken, len(keys)), which, taken


def _pair_chances(corpus: Corpus, rates: Rates, lang: int, parts: dict, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Per trigram of a bucket the probability of its last word after its middle word."""
    pairs, first, which, before = distinct(pair(v, w))
    v, w = v[first], w[first]
    hot = corpus.dealt(v) > 1
    if hot.any():
        before[hot] = _answers(parts, _ASK_PAIRS)[0]
    tally, steps = rates.words[lang], rates.steps[0][lang]
    one = np.empty(len(pairs))
    for kind, held in ((_ASK_COLD, ~hot), (_ASK_HOT, hot)):
        if held.any():
            totals = _answers(parts, kind)[0]
            chance = (totals - steps[np.minimum(totals, 3)]) / float(tally[5])
            one[held] = (chance + _taken(tally, steps) / float(tally[5]) / float(tally[4]))[distinct(w[held])[2]]
    sums, taken, at, steps2 = _level(before, v, rates.steps[1][lang])
    sums, taken = sums[at], taken[at]
    k = np.searchsorted(rates.hot, v[hot])
    sums[hot], taken[hot] = rates.hot_sum[k], rates.hot_taken[k]
    return ((before - steps2) / sums + taken / sums * one)[which]


def _scored(shared, k: int, slices: int):
    """mapInArrow function: the trigrams of a slice of the buckets, each with the texts that hold it; a block of
    texts has a number of its own and a row of their digests."""

    def scan(batches):
        corpus, part, n = shared.value, TaskContext.get().partitionId(), 0

        def made():
            src = (part << 24) + n
            bucket, v, u, w, doc = (np.concatenate(x) for x in zip(*found))
            _, first, which, times = distinct(gram(u, v, w))
            order = _by_place(bucket[first], v[first])
            place = np.empty(len(order), np.uint64)
            place[order] = np.arange(len(order), dtype=np.uint64)
            held = doc[ascending(place[which])].astype(np.uint16 if len(digests) <= 1 << 16 else np.uint32)
            order, times = first[order], times[order]
            ends = np.concatenate(([0], np.cumsum(times)))
            bucket, v, u, w = (x[order] for x in (bucket, v, u, w))
            parts = _columns(corpus, v, u, w)
            rows = [(to, _GRAMS, src, _cut(parts, corpus, i, j, *_small(times[i:j]), held[ends[i] : ends[j]]))
                    for to, i, j in _runs(bucket)]
            rows.append((-1 - src % _HEADERS, _HEADER, src, b"".join(digests)))
            return _batch(rows)

        found, digests, seen, size = [], [], set(), 0
        for piece, names in _pieces(corpus, batches, seen):
            chosen = _sliced(piece, k, slices)
            found.append((piece.bucket[chosen], piece.v[chosen], piece.u[chosen], piece.w[chosen],
                          piece.doc[chosen] + len(digests)))
            digests += names
            size += len(chosen)
            if size >= corpus.p.block_words:
                yield made()
                found, digests, size, n = [], [], 0, n + 1
                seen.clear()
        if size:
            yield made()

    return scan


def _score(shared, shared_rates):
    def score(rows: pa.Table) -> pa.Table:
        corpus, rates, bucket = shared.value, shared_rates.value, rows["bucket"][0].as_py()
        parts = _by_kind(rows)
        if bucket < 0:
            return _table([(src, _HEADER, src, blob) for src, blob in parts[_HEADER]])
        lang = corpus.lang(bucket)
        sources = [src for src, _ in parts[_GRAMS]]
        blobs = [_unpacked(blob) for _, blob in parts[_GRAMS]]
        v, u, w = _grams(corpus, blobs)
        grams, first, which, _ = distinct(gram(u, v, w))
        v, u, w = v[first], u[first], w[first]
        b = _unpacked(parts[_MANY][0][1])
        many, n_many = np.cumsum(b[0]), _whole(b[1], b[2])
        n = np.ones(len(grams), np.int64)
        n[np.searchsorted(grams, many)] = n_many
        sums, taken, at, steps = _level(n, pair(u, v), rates.steps[2][lang])
        two = _pair_chances(corpus, rates, lang, parts, v, w)
        three = (n - steps) / sums[at] + taken[at] / sums[at] * two
        loss = -np.log(np.maximum(three, 1e-12))[which]
        out, i = [], 0
        for src, b in zip(sources, blobs):
            times = _whole(b[6], b[7])
            held, inverse = np.unique(b[8], return_inverse=True)
            added = np.bincount(inverse, np.repeat(loss[i : i + len(times)], times), len(held)).astype(np.float32)
            out.append((src, _SUMS, bucket, _packed(held.astype(np.uint32), added.view(np.uint32))))
            i += len(times)
        return _table(out)

    return score


def _added(rows: pa.Table) -> pa.Table:
    """Digest and loss of every text of a block."""
    parts = _by_kind(rows)
    digests = parts[_HEADER][0][1]
    losses = np.zeros(len(digests) // 16)
    for _, blob in sorted(parts.get(_SUMS, [])):
        held, added = _unpacked(blob)
        losses[held] += added.view(np.float32)
    found = np.flatnonzero(losses)
    return pa.table({"digest": pa.array([digests[16 * k : 16 * k + 16] for k in found.tolist()], pa.binary()),
                     "loss": losses[found]})


def text_digest(lang: Column, text: Column) -> Column:
    """The 16 bytes that equal texts of one language share."""
    return F.unhex(F.md5(F.concat(F.length(lang).cast("string"), F.lit(":"), lang, text).cast("binary")))


def losses(spark: SparkSession, texts: DataFrame, totals: dict[str, int], workspace: Workspace,
           p: SweepParams = SweepParams()) -> DataFrame:
    """(digest, loss): the negative log-probability of all words of a text, for texts (lang, text, digest) without
    nulls; `totals` has the words of each language, a language without words is left out."""
    if not totals:
        return spark.createDataFrame([], "digest binary, loss double")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # what a step shuffled goes when its table is staged
    try:
        return _losses(spark, texts, Corpus(totals, p), workspace)
    finally:
        spark.conf.set(_CLEANUP, before)


def _losses(spark: SparkSession, texts: DataFrame, corpus: Corpus, workspace: Workspace) -> DataFrame:
    texts = texts.select("lang", F.col("text").cast("binary"), "digest")
    broadcast = spark.sparkContext.broadcast
    frequent = texts.mapInArrow(_frequent(broadcast(corpus)), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    frequent = frequent.orderBy(F.desc("n"), "token").limit(corpus.p.codes).toPandas()
    corpus.name_words(frequent["token"].to_numpy(np.int64).view(np.uint64), frequent["n"].to_numpy(np.int64))
    shared = broadcast(corpus)

    tallies = np.zeros((3, len(corpus.names), 6), np.uint64)

    def of(rows: DataFrame, *kinds: int) -> DataFrame:
        return rows.where(F.col("kind").isin(*kinds))

    def tally(rows: DataFrame) -> None:
        for r in of(rows, _STATS).collect():
            tallies[r["src"] - 1, corpus.lang(r["bucket"])] += _unpacked(bytes(r["blob"]))[0]

    def stepped(rows: DataFrame, step, name: str) -> DataFrame:
        return workspace.stage(rows.groupBy("bucket").applyInArrow(step, _ROWS), name)

    slices = min(corpus.p.count_slices, corpus.most_slices)
    parts = [stepped(texts.mapInArrow(_counted(shared, k, slices), _ROWS), _count(shared), "counts") for k in range(slices)]
    counts = _union(parts)
    tally(counts)
    side, asks = [workspace.stage(of(counts, _MANY), "many")], of(counts, _ASK_COLD)
    hot: dict[int, tuple[int, np.ndarray]] = {}
    if (corpus.salts > 1).any():
        pairs = of(counts, _HOT)
        side.append(stepped(pairs.mapInArrow(_ask_pairs(shared), _ROWS), _totals, "pairs"))
        more = stepped(pairs.union(of(side[-1], _ASK_PAIRS + _ANSWER)), _ask_words(shared), "asks")
        parts.append(more)
        tally(more)
        for r in of(more, _HOT_WORD).collect():
            word, found = int(np.int64(r["src"]).view(np.uint64)), _unpacked(bytes(r["blob"]))[0]
            hot[word] = (corpus.lang(r["bucket"]), found + hot[word][1] if word in hot else found)
        asks = asks.union(of(more, _ASK_HOT))
    side.append(stepped(asks, _totals, "words"))
    tally(side[-1])
    workspace.drop(*parts)
    rates = broadcast(Rates(tallies, hot, corpus))

    slices = min(corpus.p.score_slices, corpus.most_slices)
    known = _union(side).where(F.col("kind") != _STATS)
    losses = []
    for k in range(slices):
        sent = texts.mapInArrow(_scored(shared, k, slices), _ROWS).union(known.where(F.col("bucket") % slices == k))
        sums = sent.groupBy("bucket").applyInArrow(_score(shared, rates), _ROWS)
        by_text = sums.groupBy("bucket").applyInArrow(_added, "digest binary, loss double")
        # A text held by several blocks was added up in each.
        losses.append(workspace.stage(by_text.groupBy("digest").agg(F.max("loss").alias("loss")), "losses"))
    workspace.drop(*side)
    return _union(losses).groupBy("digest").agg(F.sum("loss").alias("loss"))


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole

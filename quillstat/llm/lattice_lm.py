"""Language-model scores by subword lattices (operator 10).

Two models score every whole text (null: empty), both learned from the
documents outside the held-out fold:

* base: a word unigram with add-one smoothing; tokens are the lower-cased (A-Z)
  words of the text and one end;
* lattice: the pieces of an existing subword vocabulary weight all
  segmentations of a word (a word mark, then its bytes); the forward recursion
  in log space sums them, so a word has its marginal probability, and a text the
  product of its words' and the end's (before each word the end is or is not
  drawn).  Byte pieces make every text possible.

Piece weights start from the vocabulary's own scores (for a merge vocabulary
these are ranks, read as Zipf's law) and take steps of expectation maximisation
over the training words until they settle: expected counts by forward and backward
recursion, add-one smoothed.  The smoothed objective (log-likelihood of the training
words plus the log weights' sum) rises with every step; the steps end when it rises by less
than ``SETTLED`` of itself.  All pieces of the vocabulary take part, of whatever length.

Counts cover all training documents.  Each scan portion sends its distinct words
with their counts; a frequent word costs one row per portion.  To score, the
``HEAD`` most frequent words are broadcast (a fixed bound); the counts of all
others meet the documents' words in shards, which send back one sum per document
and shard.  A word outside the head is rare, so no shard holds a hot word; there are as
many shards as the tokens outside the head ask for (``SHARD_ENTRIES``).

Edge cases: an empty text is one end; a null doc_id is a training row and gets
its own result row; repeated rows are counted and scored each; an empty table gives
no rows; without training rows every count is zero, and N is then taken as 0.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.session import ship_package

from .quality import held_out
from .shared import stash
from .textscan import BYTE_CODE, U, Words, as_bytes, column, mix, powers, slices

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 1 << 17
FOLD, FOLDS = 2, 7
ZIPF_SHIFT = 2.7
PORTION = 8 << 20
SETTLED = 1e-3
SHARD_ENTRIES = 2_000_000
FEW = 4  # words of equal length that are walked one by one instead of side by side
BLOCK = 1 << 16  # positions of a long word whose edges are held at a time
LN10 = math.log(10)
_END = -1  # the end's key among word hashes
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MARK = 1  # the word mark's code inside lattices (a control byte no piece begins with)


def read_pieces(path: str = VOCABULARY) -> tuple[list[bytes], np.ndarray]:
    """Pieces as bytes, word mark as ``_MARK``, and their log probabilities by rank.

    Every single byte is a piece, so nothing is out of vocabulary.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rank: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", chr(_MARK)).encode()
        place = model.get_piece_size() if model.is_byte(i) else -model.get_score(i)
        rank[raw] = min(rank.get(raw, math.inf), place)
    for b in range(256):
        rank.setdefault(bytes([b]), model.get_piece_size())
    pieces = sorted(p for p in rank if p)
    weight = 1 / (np.array([rank[p] for p in pieces]) + ZIPF_SHIFT)
    return pieces, np.log(weight / weight.sum())


class Lattice:
    """Forward (and backward) recursion over many words at once; words are marked byte strings."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.lengths = sorted(set(map(len, pieces)))
        key = self._keys(pieces)
        self.piece = np.argsort(key)
        self.key = key[self.piece]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.key >> U(42)).astype(np.int64)] = True
        self.weigh(logp)

    def weigh(self, logp: np.ndarray) -> Lattice:
        """Takes other log probabilities of the pieces, in the pieces' order."""
        self.logp = np.asarray(logp)[self.piece]
        return self

    @staticmethod
    def _code(buf: np.ndarray) -> np.ndarray:
        return BYTE_CODE[buf] + buf.astype(np.uint64) * U(2) + U(2)

    def _keys(self, pieces: list[bytes]) -> np.ndarray:
        out = np.zeros(len(pieces), np.uint64)
        for i, p in enumerate(pieces):
            c = self._code(np.frombuffer(p, np.uint8))
            out[i] = (c * powers(len(p))[0]).sum(dtype=np.uint64) + U(len(p))
        return mix(out)

    def edges(self, text: np.ndarray, after: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, row, index) of every piece that ends behind ``after`` in equally long rows, by end and row."""
        size = text.shape[1]
        up, down = powers(size + 1)
        total = np.zeros((len(text), size + 1), np.uint64)
        np.cumsum(self._code(text) * up[:size], axis=1, out=total[:, 1:])
        found = []
        for length in self.lengths:
            lo = max(0, after + 1 - length)
            if lo + length > size:
                continue
            k = mix((total[:, lo + length:] - total[:, lo:size + 1 - length]) * down[lo:size + 1 - length] + U(length))
            maybe = np.flatnonzero(self.seen[(k >> U(42)).astype(np.int64)])
            wanted = k.ravel()[maybe]
            at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            ok = self.key[at] == wanted
            row, begin = np.divmod(maybe[ok], k.shape[1])
            found.append((begin + lo, begin + lo + length, row, at[ok]))
        begin, end, row, at = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else [()] * 4))
        order = np.lexsort((row, end))
        return begin[order], end[order], row[order], at[order]

    @staticmethod
    def _sweep(value: np.ndarray, positions, here: np.ndarray, there: np.ndarray, row: np.ndarray, weight: np.ndarray) -> None:
        """value[here] = log of the sum over edges of exp(value[there] + weight), position by position.

        Edges are sorted by ``here`` and row; ``positions`` gives the order of visits.
        """
        bound = np.searchsorted(here, np.arange(len(value) + 1))
        for p in positions:
            a, b = bound[p], bound[p + 1]
            if a < b:
                r = row[a:b]
                first = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
                value[p, r[first]] = np.logaddexp.reduceat(value[there[a:b], r] + weight[a:b], first)

    @staticmethod
    def _walk(value: array, here: np.ndarray, there: np.ndarray, weight: np.ndarray) -> None:
        """The same for a single word; edges come in the order of visits."""
        edge = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]])).tolist() if len(here) else []
        position, source, weights = here.tolist(), there.tolist(), weight.tolist()
        for a, b in zip(edge, [*edge[1:], len(position)]):
            if b - a == 1:
                value[position[a]] = value[source[a]] + weights[a]
            else:
                terms = [value[s] + w for s, w in zip(source[a:b], weights[a:b])]
                top = max(terms)
                value[position[a]] = top + math.log(sum([math.exp(t - top) for t in terms])) if top > -math.inf else top

    @staticmethod
    def _blocks(word: np.ndarray) -> range:
        return range(0, len(word), BLOCK)

    def _block(self, word: np.ndarray, lo: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, index) of the edges that end in a block of a single word."""
        before = max(0, lo - self.lengths[-1])
        begin, end, _, at = self.edges(word[None, before:lo + BLOCK], lo - before)
        return begin + before, end + before, at

    def _one(self, word: np.ndarray) -> array:
        alpha = array("d", bytes(8)) + array("d", [-math.inf]) * len(word)
        for lo in self._blocks(word):
            begin, end, at = self._block(word, lo)
            self._walk(alpha, end, begin, self.logp[at])
        return alpha

    def marginals(self, words: list[bytes]) -> np.ndarray:
        """Natural-log marginal probability of each marked word."""
        out = np.zeros(len(words))
        for size, rows, text in by_length(words):
            if len(rows) <= FEW:
                for i, word in zip(rows, text):
                    out[i] = self._one(word)[size]
                continue
            begin, end, row, at = self.edges(text)
            alpha = np.full((size + 1, len(text)), -np.inf)
            alpha[0] = 0
            self._sweep(alpha, range(1, size + 1), end, begin, row, self.logp[at])
            out[rows] = alpha[size]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Expected uses of each piece over the words, weighted by their counts, and the words' log-likelihood."""
        out, likelihood = np.zeros(len(self.key)), 0.0
        for size, rows, text in by_length(words):
            if len(rows) <= FEW:
                for i, word in zip(rows, text):
                    alpha = self._one(word)
                    beta = array("d", [-math.inf]) * size + array("d", bytes(8))
                    forward = np.frombuffer(alpha)
                    for lo in reversed(self._blocks(word)):
                        self._back(word, lo, forward, beta, float(counts[i]), out)
                    likelihood += float(counts[i]) * alpha[size]
                continue
            begin, end, row, at = self.edges(text)
            weight = self.logp[at]
            alpha = np.full((size + 1, len(text)), -np.inf)
            alpha[0] = 0
            self._sweep(alpha, range(1, size + 1), end, begin, row, weight)
            beta = np.full((size + 1, len(text)), -np.inf)
            beta[size] = 0
            back = np.lexsort((row, begin))
            self._sweep(beta, range(size - 1, -1, -1), begin[back], end[back], row[back], weight[back])
            n = np.asarray(counts)[rows]
            share = np.exp(alpha[begin, row] + weight + beta[end, row] - alpha[size, row]) * n[row]
            out += np.bincount(at, share, len(out))
            likelihood += float((n * alpha[size]).sum())
        uses = np.zeros(len(self.key))
        uses[self.piece] = out
        return uses, likelihood

    def _back(self, word: np.ndarray, lo: int, alpha: np.ndarray, beta: array, n: float, out: np.ndarray) -> None:
        """Backward recursion of one block of a single word: edges that begin in it (they may end up to a piece behind)."""
        stop = min(len(word), lo + BLOCK + self.lengths[-1])
        begin, end, _, at = self.edges(word[None, lo:stop])
        begin, end = begin + lo, end + lo
        own = begin < lo + BLOCK
        begin, end, at = begin[own], end[own], at[own]
        order = np.argsort(-begin, kind="stable")
        self._walk(beta, begin[order], end[order], self.logp[at[order]])
        share = np.exp(alpha[begin] + self.logp[at] + np.frombuffer(beta)[end] - alpha[-1]) * n
        np.add(out, np.bincount(at, share, len(out)), out=out)


def by_length(words: list[bytes], limit: int = 1 << 17) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Words of equal length as a matrix of bytes, in portions of bounded size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    edge = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, edge):
        if not len(group):
            continue
        size = int(lengths[group[0]])
        step = max(1, limit // (size * min(size, 16)))
        for lo in range(0, len(group), step):
            rows = group[lo:lo + step]
            yield size, rows, np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), size)


def marked(words: list[bytes]) -> list[bytes]:
    return [bytes([_MARK]) + w for w in words]


def _portions(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    return slices(texts, PORTION)


def _distinct(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], list[Words]]:
    """Distinct lower-cased words: sorted hashes, inverse over all words in order, texts' word counts, words."""
    scans = []
    for lo, hi in slices(texts):
        scans.append(Words([t.translate(_LOWER) for t in texts[lo:hi]]))
    hashes = np.concatenate([w.hash for w in scans]) if scans else np.zeros(0, np.uint64)
    key, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    bound = np.concatenate([[0], np.cumsum([len(w.hash) for w in scans])])
    scan_of = np.searchsorted(bound, first, "right") - 1
    words = [scans[s].word(i - bound[s]) for s, i in zip(scan_of.tolist(), first.tolist())]
    count = np.concatenate([w.count for w in scans]) if scans else np.zeros(0, np.int64)
    return key, inverse, count, words, scans


COUNTS = "h long, n long, word binary"


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(column(batch, "text"))
        for lo, hi in _portions(texts):
            key, inverse, _, words, _ = _distinct(texts[lo:hi])
            n = np.bincount(inverse, minlength=len(key))
            yield pa.RecordBatch.from_arrays([pa.array(np.append(key.view(np.int64), _END)), pa.array(np.append(n, hi - lo)), pa.array([*words, b""], pa.binary())],
                                             names=["h", "n", "word"])


def _expect(model, weights):
    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = model.value.weigh(weights.value)
        total, likelihood = np.zeros(len(lattice.key)), 0.0
        for batch in batches:
            words = as_bytes(column(batch, "word"))
            uses, ll = lattice.expected(marked(words), column(batch, "n").to_numpy())
            total, likelihood = total + uses, likelihood + ll
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], likelihood))], names=["piece", "uses"])
    return expect


def fit_pieces(words: DataFrame, lattice: Lattice, logp: np.ndarray, model, settled: float = SETTLED) -> tuple[np.ndarray, list[float]]:
    """Log probabilities of the pieces (bounded by the vocabulary) after the last EM step over all training words.

    Also the objective before each step.  ``model`` is the broadcast lattice.
    """
    spark = words.sparkSession
    words, course = words.select("word", "n"), []
    while True:
        weights = spark.sparkContext.broadcast(logp)
        rows = words.mapInArrow(_expect(model, weights), "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        uses, likelihood = np.zeros(len(lattice.key)), 0.0
        for r in rows:
            if r.piece < 0:
                likelihood = r.uses
            else:
                uses[r.piece] = r.uses
        weights.unpersist()
        course.append(likelihood + float(logp.sum()))
        logp = np.log((uses + 1) / (uses.sum() + len(uses)))
        if not uses.any() or len(course) > 1 and course[-1] - course[-2] < settled * abs(course[-1]):
            return logp, course


HEAD_PART = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, log_sum double, lattice double, shard int, tail binary"


def _score(state, model, bits: int):
    """Per document: tokens, what the head words give, the lattice's sum; per portion and shard: the other words."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, head_count, logp = state.value
        lattice = model.value.weigh(logp)
        log_count = np.log10(head_count + 1.0)
        known: dict[str, np.ndarray] = {"key": np.zeros(0, np.uint64), "value": np.zeros(0)}
        for batch in batches:
            texts = as_bytes(column(batch, "text"))
            ids, held, rows = column(batch, "doc_id"), column(batch, "held_out"), column(batch, "row").to_numpy()
            for lo, hi in _portions(texts):
                key, inverse, count, words, _ = _distinct(texts[lo:hi])
                doc = np.repeat(np.arange(hi - lo), count)
                value = np.zeros(len(key))
                old = np.zeros(len(key), bool)
                if len(known["key"]):
                    at = np.minimum(np.searchsorted(known["key"], key), len(known["key"]) - 1)
                    old = known["key"][at] == key
                    value[old] = known["value"][at[old]]
                new = np.flatnonzero(~old)
                value[new] = lattice.marginals(marked([words[i] for i in new.tolist()]))
                if len(known["key"]) < HEAD:
                    merged, first = np.unique(np.concatenate([known["key"], key]), return_index=True)
                    known = {"key": merged, "value": np.concatenate([known["value"], value])[first]}
                at = np.minimum(np.searchsorted(head, key), max(0, len(head) - 1))
                top = head[at] == key if len(head) else np.zeros(len(key), bool)
                part = np.where(top, log_count[at] if len(head) else 0.0, 0.0)
                n_known = np.bincount(doc, top[inverse], hi - lo).astype(np.int64)
                log_sum = np.bincount(doc, part[inverse], hi - lo).astype(np.float64)
                sums = np.bincount(doc, value[inverse], hi - lo) / LN10
                base = pa.RecordBatch.from_arrays(
                    [pa.array(rows[lo:hi]), ids.slice(lo, hi - lo), held.slice(lo, hi - lo), pa.array(count + 1), pa.array(n_known), pa.array(log_sum), pa.array(sums),
                     pa.nulls(hi - lo, pa.int32()), pa.nulls(hi - lo, pa.binary())], names=[f.split()[0] for f in HEAD_PART.split(", ")])
                yield base
                tail = np.flatnonzero(~top[inverse])
                pair = np.stack([key[inverse[tail]], doc[tail].astype(np.uint64)])
                order = np.lexsort((pair[1], pair[0]))
                pair = pair[:, order]
                first = np.flatnonzero(np.concatenate([[True], (pair[:, 1:] != pair[:, :-1]).any(0)])) if pair.shape[1] else np.zeros(0, np.int64)
                times = np.diff(np.append(first, pair.shape[1]))
                h, d = pair[0][first], pair[1][first].astype(np.int64)
                shard = (h >> U(64 - bits)).astype(np.int64)
                cut = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
                out = [(int(shard[a]), h[a:b], rows[lo + d[a:b]], times[a:b]) for a, b in zip(cut[:-1], cut[1:])]
                if out:
                    m = len(out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), *[pa.nulls(m, pa.int64())] * 2, *[pa.nulls(m, pa.float64())] * 2,
                         pa.array([x[0] for x in out], pa.int32()), pa.array([_pack(*x[1:]) for x in out], pa.binary())], names=base.schema.names)
    return score


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(np.ascontiguousarray(values.astype(np.int64)).view(np.uint8).reshape(-1, 8).T).tobytes()


def _pack(h: np.ndarray, row: np.ndarray, times: np.ndarray) -> bytes:
    """Words and rows of a portion, as byte planes: high bytes are equal and cost little in the shuffle."""
    return np.int64(len(h)).tobytes() + _planes(h.view(np.int64)) + _planes(row) + _planes(times)


def _unpack(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob[:8], np.int64)[0])
    body = np.frombuffer(blob, np.uint8, offset=8).reshape(3, 8, n)
    return [np.ascontiguousarray(p.T).reshape(-1).view(np.int64) for p in body]


def _meet(bits: int):
    """Shard task: the counts of words meet the documents' words; one sum per document of the shard."""
    def meet(tails: pa.Table, counts: pa.Table) -> pa.Table:
        empty = pa.table({"row": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "log_sum": pa.array([], pa.float64())})
        if not tails.num_rows or not counts.num_rows:
            return empty
        h = counts.column("h").to_numpy()
        order = np.argsort(h)
        h, logs = h[order], np.log10(counts.column("n").to_numpy()[order] + 1.0)
        rows, known, sums = [], [], []
        for blob in tails.column("tail").to_pylist():
            w, row, times = _unpack(blob)
            at = np.minimum(np.searchsorted(h, w), len(h) - 1)
            ok = h[at] == w
            own, inverse = np.unique(row[ok], return_inverse=True)
            rows.append(own)
            known.append(np.bincount(inverse, times[ok], len(own)).astype(np.int64))
            sums.append(np.bincount(inverse, times[ok] * logs[at[ok]], len(own)).astype(np.float64))  # of nothing, bincount is integral
        return pa.table({"row": np.concatenate(rows), "n_known": np.concatenate(known), "log_sum": np.concatenate(sums)})
    return meet


def lattice_scores(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``."""
    ship_package(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", held_out(FOLD, FOLDS).alias("held_out"))
    counts = stash(docs.where(~F.col("held_out")).select("text").mapInArrow(_count_words, COUNTS)
                   .groupBy("h").agg(F.sum("n").alias("n"), F.min("word").alias("word")), "lm-counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("h") == _END, F.col("n"))), F.lit(0))).first()
    total, distinct, ends = (int(x) for x in whole)
    words = counts.where(F.col("h") != _END)
    top = words.orderBy(F.desc("n"), "h").limit(HEAD).select("h", "n").toArrow()  # HEAD rows of two numbers
    head = top.column("h").to_numpy().view(np.uint64)
    order = np.argsort(head)
    head, head_count = head[order], top.column("n").to_numpy()[order]
    pieces, logp = read_pieces(path)
    lattice = Lattice(pieces, logp)
    model = spark.sparkContext.broadcast(lattice)
    logp, _ = fit_pieces(words, lattice, logp, model)
    state = spark.sparkContext.broadcast((head, head_count, logp))
    rare_tokens = max(0, total - ends - int(head_count.sum())) * FOLDS / (FOLDS - 1)  # the held-out fold has its share of them
    bits = min(30, max(4, math.ceil(math.log2(max(1, distinct) / 50_000)) if distinct else 4, math.ceil(math.log2(max(1, rare_tokens) / SHARD_ENTRIES))))
    numbered = docs.withColumn("row", F.monotonically_increasing_id())  # only has to agree within what is written next
    parts = stash(numbered.mapInArrow(_score(state, model, bits), HEAD_PART), "lm-parts")
    rare = (words.select("h", "n").withColumn("shard", F.shiftrightunsigned("h", 64 - bits).cast("int")))
    back = (parts.where("shard is not null").select("shard", "tail").groupBy("shard").cogroup(rare.groupBy("shard"))
            .applyInArrow(_meet(bits), "row long, n_known long, log_sum double")
            .groupBy("row").agg(F.sum("n_known").alias("more_known"), F.sum("log_sum").alias("more_sum")))
    denominator = math.log10(total + distinct + 1)
    end = math.log10(ends + 1)
    end_lattice = _end_log10(ends, total)
    zero = F.lit(0)
    return (parts.where("shard is null").drop("shard", "tail").join(back, "row", "left")
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("n_known") + F.coalesce("more_known", zero) + F.lit(1 if ends else 0)).cast("long").alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0)) + F.lit(end) - F.col("n_tokens") * F.lit(denominator)).alias("base_score"),
                    (F.col("lattice") + (F.col("n_tokens") - 1) * F.lit(end_lattice[0]) + F.lit(end_lattice[1])).alias("score")))


def _end_log10(ends: int, total: int) -> tuple[float, float]:
    """Log10 probabilities, at each step, of another word and of the end."""
    p = (ends + 1) / (total + 2)
    return math.log10(1 - p), math.log10(p)

"""Document likelihood from a lattice of subword segmentations.

The probability of a word sums over *all* its segmentations into pieces of an existing vocabulary: a forward
recursion in log space over the byte positions of the word.  The vocabulary's own scores weight the lattice
first; expectation steps over all distinct training words (forward and backward) turn them into piece
probabilities of this corpus.  A training word is also a unit of its own, an edge over the whole word, with its
discounted relative count; the lattice of pieces holds the mass that discounting frees.  So

    P(word) = (count - d)+ / N  +  d * V / N * P_pieces(word),

which sums to one over all words, and a text's probability is the product over its words and one end.

How it runs: texts are tokenized once, in blocks of bounded size, into an inverted table (word, block, postings)
in the shared folder.  Counts are sums over it; every distinct word passes the lattice once; scores return to the
blocks by a join on the word and are added up per block.  Nothing but the piece table (its size is the
vocabulary's) and two totals reaches the driver.
"""

from __future__ import annotations

import math
from collections import defaultdict, deque

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tickforge.session import stage

BLOCK_BYTES = 16_000_000
BLOCK_DOCS = 1 << 20          # a posting holds 20 bits of document, 12 of count
LONG_WORD = 128               # longer words are rare and go one by one
GROUP_CELLS = 2_000_000       # words x positions handled at once
MAX_PIECE = 16
EM_STEPS = 2
END_SHARE = 0.01              # of the pieces' mass, for the end of a text
POSTINGS = ("block string, word binary, n_train bigint, post binary, "
            "ids array<string>, n_tokens array<bigint>, held array<boolean>")


def read_vocabulary(path: str) -> list[tuple[bytes, float]]:
    """(piece, log weight) of a sentencepiece file.  Control and byte pieces are left out (single bytes are
    always in the lattice); marks of a word's start are dropped, as every word starts a lattice.  The file's
    scores are negative merge ranks, read as the log weights of Zipf's law; a unigram file's are log
    probabilities and are taken as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    best: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_byte(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i).replace("▁", "").encode().lower()
        score = model.get_score(i)
        weight = -math.log(2.0 - score) if score <= 0 and float(score).is_integer() else score
        if piece and len(piece) <= MAX_PIECE:
            best[piece] = max(weight, best.get(piece, -math.inf))
    return sorted(best.items())


class Lattice:
    """Pieces with log probabilities; single bytes are always among them."""

    def __init__(self, pieces: list[tuple[bytes, float]]):
        known = dict(pieces)
        floor = min(known.values(), default=0.0) - 2.0
        for b in range(256):
            known.setdefault(bytes([b]), floor)
        self.pieces = sorted(known)
        self.index = {p: i for i, p in enumerate(self.pieces)}
        self.longest = max(map(len, self.pieces))
        weights = np.array([known[p] for p in self.pieces])
        total = np.logaddexp.reduce(weights)
        self.set_probabilities(weights - total + math.log(0.75), math.log(0.25))
        keys = np.array([self._hash(p) for p in self.pieces], dtype=np.uint64)
        self.order = np.argsort(keys)
        self.keys = keys[self.order]
        self.maybe, self.begun = np.zeros(1 << 20, dtype=bool), np.zeros(1 << 20, dtype=bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        begins = {p[:k] for p in self.pieces for k in range(1, len(p))}     # a word without one has no longer piece there
        self.begun[np.array([self._hash(p) for p in begins], dtype=np.uint64) >> np.uint64(44)] = True

    def set_probabilities(self, log_p, log_end: float) -> None:
        self.log_p, self.log_end = np.asarray(log_p, dtype=float), log_end

    def learn(self, expected: dict[int, float], words: float) -> None:
        """Probabilities from expected piece counts, with a trace of the old ones for unused pieces."""
        counts = np.exp(self.log_p)
        for i, x in expected.items():
            counts[i] += x
        total = counts.sum() + words
        if words:
            self.set_probabilities(np.log(counts / total), math.log(words / total))

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for x in piece:
            h = ((h + x + 1) * 0x9E3779B97F4A7C15) % (1 << 64)
            h ^= h >> 29
        return h

    def _edges(self, group: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """The words of equal length that have a piece from start to end, and its index, by (start, end)."""
        n, length = group.shape
        out = {}
        columns = np.ascontiguousarray(group.T) + np.uint64(1)
        for s in range(length):
            h, rows = np.zeros(n, dtype=np.uint64), np.arange(n)
            for e in range(s + 1, min(length, s + self.longest) + 1):
                h = (h + columns[e - 1, rows]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                cell = h >> np.uint64(44)
                at = np.flatnonzero(self.maybe[cell])
                if len(at):
                    key = h[at]
                    found = np.searchsorted(self.keys, key)
                    found[found == len(self.keys)] = 0
                    hit = self.keys[found] == key
                    if hit.any():
                        out[s, e] = rows[at[hit]], self.order[found[hit]]
                on = np.flatnonzero(self.begun[cell])
                if not len(on):
                    break
                h, rows = h[on], rows[on]
        return out

    def _forward(self, edges: dict, n: int, length: int) -> tuple[np.ndarray, dict]:
        with np.errstate(divide="ignore"):
            alpha = np.full((length + 1, n), -np.inf)
            alpha[0] = 0.0
            scores = {k: self.log_p[ids] for k, (_, ids) in edges.items()}
            for e in range(1, length + 1):
                for s in range(max(0, e - self.longest), e):
                    if (s, e) in scores:
                        at = edges[s, e][0]
                        alpha[e, at] = np.logaddexp(alpha[e, at], alpha[s, at] + scores[s, e])
        return alpha, scores

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the marginal probability of each word."""
        out = np.zeros(len(words))
        for at, group in groups(words):
            n, length = group.shape
            alpha, _ = self._forward(self._edges(group), n, length)
            out[at] = alpha[length]
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self.one(w)
        return out + self.log_end

    def one(self, word: bytes) -> float:
        """The same recursion for one word of any length, without its end."""
        return self._alphas(word)[-1]

    def _alphas(self, word: bytes) -> list[float]:
        alpha = [0.0]
        get, log_p = self.index.get, self.log_p
        for e in range(1, len(word) + 1):
            terms = [alpha[s] + log_p[i] for s in range(max(0, e - self.longest), e)
                     if (i := get(word[s:e])) is not None]
            alpha.append(_log_sum(terms))
        return alpha

    def _expect_one(self, word: bytes, total: np.ndarray) -> None:
        """Add the expected uses of each piece in one word of any length: its forward weights are kept, of its backward
        ones only those that the longest piece reaches."""
        alpha = self._alphas(word)
        get, log_p, n = self.index.get, self.log_p, len(word)
        beta = deque([0.0], maxlen=self.longest)      # of the positions s + 1, s + 2, ...
        for s in range(n - 1, -1, -1):
            terms = []
            for k, behind in enumerate(beta):
                i = get(word[s:s + k + 1])
                if i is not None:
                    terms.append(log_p[i] + behind)
                    total[i] += math.exp(alpha[s] + terms[-1] - alpha[n])
            beta.appendleft(_log_sum(terms))

    def expected(self, words: list[bytes]) -> np.ndarray:
        """Expected uses of each piece over one occurrence of each word, whatever its length."""
        total = np.zeros(len(self.pieces))
        for w in words:
            if len(w) > LONG_WORD:
                self._expect_one(w, total)
        for _, group in groups(words):
            n, length = group.shape
            edges = self._edges(group)
            alpha, scores = self._forward(edges, n, length)
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = 0.0
            with np.errstate(divide="ignore", invalid="ignore"):
                for s in range(length - 1, -1, -1):
                    for e in range(s + 1, min(length, s + self.longest) + 1):
                        if (s, e) in scores:
                            at = edges[s, e][0]
                            beta[s, at] = np.logaddexp(beta[s, at], scores[s, e] + beta[e, at])
                for (s, e), (at, ids) in edges.items():
                    share = np.exp(alpha[s, at] + scores[s, e] + beta[e, at] - alpha[length, at])
                    np.add.at(total, ids, share)
        return total


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top + math.log(sum(math.exp(x - top) for x in terms))


def groups(words: list[bytes]):
    """(positions, byte matrix) of words of equal length, in groups of bounded size; longer words than LONG_WORD go
    through the recursion for one word, so every word is counted and scored."""
    by_length = defaultdict(list)
    for i, w in enumerate(words):
        if 0 < len(w) <= LONG_WORD:
            by_length[len(w)].append(i)
    for length, at in by_length.items():
        step = max(1, GROUP_CELLS // (length * MAX_PIECE))
        for k in range(0, len(at), step):
            part = at[k:k + step]
            yield np.array(part), np.frombuffer(b"".join(words[i] for i in part), dtype=np.uint8).reshape(
                len(part), length).astype(np.uint64)


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(0x09, 0x0E), 0x20]] = True


def _tokens(texts: pa.LargeBinaryArray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """Lower-cased words of all texts, one after the other, and how many each text has."""
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2].slice(bounds[0], bounds[-1] - bounds[0]).to_pybytes() if bounds[-1] > bounds[0] else b""
    data, bounds = np.frombuffer(data.lower(), dtype=np.uint8), bounds - bounds[0]
    inside = ~_BLANK[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin, end = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0] - 1
    first[begin], last[end] = inside[begin], inside[end]     # no word runs on into the next text
    starts = np.flatnonzero(first)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - starts)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    return words, np.diff(np.searchsorted(starts, bounds))


class _Block:
    """Rows of one block; they are inverted together, by one sort of (word, document) numbers."""

    def __init__(self, name: str):
        self.name, self.size, self.docs, self.parts = name, 0, 0, []

    def add(self, part: pa.RecordBatch, size: int) -> None:
        self.parts.append(part)
        self.docs += part.num_rows
        self.size += size

    def postings(self) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
        """Distinct words, the last of them the end; their training counts and postings; words of each document."""
        held = np.concatenate([p.column(2).to_numpy(zero_copy_only=False) for p in self.parts])
        words, n_words = _tokens(pa.concat_arrays([p.column(1) for p in self.parts]))
        words = words.dictionary_encode()
        known = pa.concat_arrays([words.dictionary.cast(pa.binary()), pa.array([b""], pa.binary())])
        docs = np.arange(self.docs)
        at = np.concatenate([words.indices.to_numpy().astype(np.int64) << 20 | np.repeat(docs, n_words),
                             (len(known) - 1) << 20 | docs])
        at.sort()
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        times, at = np.diff(first, append=len(at)), at[first]
        word, doc = at >> 20, at & (BLOCK_DOCS - 1)
        train = np.bincount(word, weights=np.where(held[doc], 0, times), minlength=len(known)).astype(np.int64)
        shares = -(-times // 4095)       # entries that the count of one word in one document takes
        entries = np.repeat(doc << 12 | 4095, shares)
        entries[np.cumsum(shares) - 1] += times - shares * 4095
        sizes = np.bincount(word, weights=shares, minlength=len(known)).astype(np.int64) * 4
        post = pa.Array.from_buffers(pa.binary(), len(known), [
            None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
            pa.py_buffer(entries.astype(np.uint32))])
        return known, train, post, n_words

    def batches(self, schema: pa.Schema):
        words, train, post, n_words = self.postings()
        for k in range(0, len(words), 20_000):
            part = words.slice(k, 20_000)
            n = len(part)
            yield pa.RecordBatch.from_arrays([
                pa.array([self.name] * n, pa.string()), part, pa.array(train[k:k + n]), post.slice(k, n),
                pa.nulls(n, schema.field("ids").type), pa.nulls(n, schema.field("n_tokens").type),
                pa.nulls(n, schema.field("held").type)], schema=schema)
        whole = lambda column: pa.ListArray.from_arrays([0, len(column)], column)
        yield pa.RecordBatch.from_arrays([
            pa.array([self.name]), pa.nulls(1, pa.binary()), pa.array([0], pa.int64()), pa.nulls(1, pa.binary()),
            whole(pa.concat_arrays([p.column(0) for p in self.parts])), whole(pa.array(n_words + 1)),
            whole(pa.concat_arrays([p.column(2) for p in self.parts]))], schema=schema)


SCHEMA = pa.schema([("block", pa.string()), ("word", pa.binary()), ("n_train", pa.int64()), ("post", pa.binary()),
                    ("ids", pa.list_(pa.string())), ("n_tokens", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))])


def _invert(batches):
    part, number = TaskContext.get().partitionId(), 0
    block = _Block(f"{part}-{number}")
    for batch in batches:
        texts = pc.fill_null(batch.column(1), "")
        batch = pa.RecordBatch.from_arrays([batch.column(0), texts.cast(pa.large_binary()), batch.column(2)],
                                           names=["key", "text", "held"])
        sizes, at = np.cumsum(pc.utf8_length(texts).to_numpy() + 64, dtype=np.int64), 0
        while at < len(sizes):
            before = sizes[at - 1] if at else 0
            full = int(np.searchsorted(sizes, before + BLOCK_BYTES - block.size)) + 1    # rows until the block is full
            end = min(full, at + BLOCK_DOCS - block.docs, len(sizes))
            block.add(batch.slice(at, end - at), int(sizes[end - 1] - before))
            at = end
            if block.size >= BLOCK_BYTES or block.docs >= BLOCK_DOCS:
                yield from block.batches(SCHEMA)
                number += 1
                block = _Block(f"{part}-{number}")
    if block.docs:
        yield from block.batches(SCHEMA)


def invert(docs: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    """(word, block) with the documents and counts of the word, and one row per block that describes its
    documents.  The empty word is the end of a text."""
    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"),
                       F.coalesce(held, F.lit(False)).alias("held")).mapInArrow(_invert, POSTINGS)


def _larger(batches, rows: int = 50_000):
    """The same rows in larger batches: the lattice handles words of one length together."""
    held = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _expect(lattice: Lattice):
    def run(batches):
        total = np.zeros(len(lattice.pieces))
        for b in _larger(batches):
            total += lattice.expected([w for w in b.column(0).to_pylist() if w])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["piece", "uses"])
    return run


def _score(lattice: Lattice, n: int, v: int, discount: float):
    def run(batches):
        for b in _larger(batches):
            words, c = b.column(0).to_pylist(), b.column(1).to_numpy().astype(float)
            logs = lattice.log_probability(words) + math.log1p(-END_SHARE)
            for i, w in enumerate(words):
                if not w:
                    logs[i] = math.log(END_SHARE)
            if n:
                own = np.maximum(c - discount, 0.0) / n
                free = math.log(discount * v / n)
                with np.errstate(divide="ignore"):
                    logs = np.logaddexp(np.log(own), free + logs)
            base = np.log10((c + 1.0) / (n + v + 1.0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(c > 0), pa.array(base), pa.array(logs / math.log(10.0))],
                names=["word", "known", "base", "model"])
    return run


def _gather(out: pa.Table) -> pa.Table:
    """Scores of one block's documents."""
    marks = out.filter(pc.is_valid(out["ids"]))
    rows = out.filter(pc.is_valid(out["post"]))
    ids = marks["ids"][0].as_py()
    base, model, known = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids), dtype=np.int64)
    for chunk in rows.to_batches():
        post = chunk.column(chunk.schema.get_field_index("post"))
        offsets = np.frombuffer(post.buffers()[1], dtype=np.int32)[post.offset:post.offset + len(post) + 1]
        entries = np.frombuffer(post.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]].view(np.uint32)
        repeat = np.diff(offsets) // 4
        doc, times = (entries >> np.uint32(12)).astype(np.int64), (entries & np.uint32(4095)).astype(float)
        column = lambda name: chunk.column(chunk.schema.get_field_index(name)).to_numpy(zero_copy_only=False)
        spread = lambda name: np.repeat(column(name), repeat)
        base += np.bincount(doc, weights=times * spread("base"), minlength=len(ids))
        model += np.bincount(doc, weights=times * spread("model"), minlength=len(ids))
        known += np.bincount(doc, weights=times * spread("known"), minlength=len(ids)).astype(np.int64)
    return pa.table({"key": pa.array(ids, pa.string()), "held_out": pa.array(marks["held"][0].as_py(), pa.bool_()),
                     "n_tokens": pa.array(marks["n_tokens"][0].as_py(), pa.int64()), "n_known": pa.array(known),
                     "base_score": pa.array(base), "score": pa.array(model)})


def score(docs: DataFrame, vocabulary: list[tuple[bytes, float]], key: str = "doc_id", text: str = "text",
          held: Column | None = None) -> DataFrame:
    """One row per document: ``key``, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``held`` marks documents that are scored but not learned from (null: not held out).  A null text is empty: its
    only token is the end.  Repeated rows are scored, and learned from, each by itself; null ids stay null.
    Without training documents the pieces alone give the score.  Other columns are not read.
    """
    kind = dict(docs.dtypes)[key]
    post = stage(invert(docs, key, text, F.lit(False) if held is None else held), "postings")
    words = stage(post.where("word is not null").groupBy("word").agg(F.sum("n_train").alias("c")), "words")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1),
                      F.count_if(F.col("c") == 2), F.count_if((F.col("c") > 0) & (F.length("word") > 0))).first()
    n, v, once, twice, types = total
    discount = min(0.95, max(0.1, once / (once + 2 * twice))) if once else 0.5
    lattice = Lattice(vocabulary)
    for _ in range(EM_STEPS):
        uses = (words.where("c > 0").select("word").mapInArrow(_expect(lattice), "piece bigint, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")))
        lattice.learn({r.piece: r.uses for r in uses.collect()}, float(types))   # one row per piece
    scored = words.mapInArrow(_score(lattice, n, v, discount), "word binary, known boolean, base double, model double")
    blank = {"known": F.lit(None).cast("boolean"), "base": F.lit(None).cast("double"),
             "model": F.lit(None).cast("double")}
    keep = ["block", "post", "ids", "n_tokens", "held", "known", "base", "model"]
    joined = post.where("word is not null").join(scored, "word").select(*keep).union(
        post.where("word is null").withColumns(blank).select(*keep))
    out = joined.groupBy("block").applyInArrow(
        _gather, "key string, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
    return out.select(F.col("key").cast(kind).alias(key), "held_out", "n_tokens", "n_known",
                      F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")

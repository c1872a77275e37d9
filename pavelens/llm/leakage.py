"""Test items that leak into a corpus, found by latent semantic retrieval and checked word by word.

1. Words are maximal runs of letters and digits after NFKC and lower-casing. One pass over the texts
   turns them into numbers of the items' vocabulary (0 for any other word, called foreign) and keeps the
   documents that have a window with at most `window - need` foreign words: no other window can share
   `need` words with an item.
2. Document frequencies come from all documents. A randomised singular value decomposition of the
   TF-IDF passages of all items and of a bounded sample of documents (`sample_docs`, by a hash of the id)
   gives the latent space; its power iterations are Spark jobs that add up one small matrix each.
3. Equal windows (need = window): every window of every kept document is projected and compared with the
   item windows by cosine; item windows are grouped around centres and the triangle inequality of angles
   passes over whole groups.
4. Windows that share `need` of more words: candidates are all pairs in which `need` positions of the document's
   window have a word of the item's window. No cosine can be asked of them: it depends on the weights.
5. Candidates are checked: a common run of `need` words, or a longest common subsequence.

With windows as long as the wanted run, at every position, a shared run makes two equal windows; these
have the same latent vector and cosine 1 whatever the space is, so the candidate search is complete. A common
subsequence of `need` words has as many shared positions, so the search by counts is complete too.

6. Where items have a question or answer line, a pair that shares fewer words than `need` but `answer_need` still counts
if the document has that line word by word.

Null and empty texts and items shorter than the run match nothing. Repeated rows count once. Items are
taken in blocks of BLOCK_CHARS characters, so what is broadcast is bounded however many there are. With more than one
block the texts are taken apart once, into 64-bit hashes of their words, and every block reads these.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pavelens.session import Scratch

BLOCK_CHARS = 1 << 20
_WORDS = re.compile(r"[^\W_]+")
_TAIL = re.compile(r"(?:question|frage|answer|antwort)\s*:", re.IGNORECASE)


@dataclass(frozen=True)
class LeakRules:
    """window, stride: of the passages; item_stride: of the items' passages. need: words that must be shared.
    subsequence: whether the shared words may have others between them. cos_min: of candidates, if need = window.
    answer_need: words that are enough if the document has the item's question or answer line too; 0 for no such rule."""

    window: int = 12
    stride: int = 1
    item_stride: int = 1
    need: int = 12
    subsequence: bool = False
    cos_min: float = 0.999
    rank: int = 64
    sample_docs: int = 2_000
    power_rounds: int = 2
    centres: int = 512
    answer_need: int = 0

    @property
    def least(self) -> int:
        """Shared words below which no pair counts."""
        return min(self.need, self.answer_need or self.need)

    @property
    def by_counts(self) -> bool:
        return self.subsequence or self.need < self.window


def words(text: str | None) -> list[str]:
    text = text or ""
    return _WORDS.findall((text if text.isascii() else unicodedata.normalize("NFKC", text)).lower())


def windows(ids: np.ndarray, size: int, stride: int, need: int) -> np.ndarray:
    """Windows of a document at every stride, the end included; the last one is filled up with -1 if the text is short."""
    n = len(ids)
    if n < need:
        return np.zeros((0, size), np.int32)
    if n < size:
        return np.concatenate([ids, np.full(size - n, -1, ids.dtype)])[None, :]
    starts = np.arange(0, n - size + 1, stride)
    if starts[-1] != n - size:
        starts = np.append(starts, n - size)
    return np.lib.stride_tricks.sliding_window_view(ids, size)[starts]


def longest_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common run of known words of each pair of windows."""
    n, w = a.shape
    best = np.zeros(n, np.int32)
    for shift in range(-(w - 1), w):
        x, y = (a[:, shift:], b[:, : w - shift]) if shift >= 0 else (a[:, :shift], b[:, -shift:])
        run = np.zeros(n, np.int32)
        same = (x == y) & (x > 0)
        for k in range(same.shape[1]):
            run = (run + 1) * same[:, k]
            np.maximum(best, run, out=best)
    return best


def longest_subsequence(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of known words of each pair of windows."""
    n, w = a.shape
    row = np.zeros((w + 1, n), np.int32)
    for i in range(w):
        diagonal = np.zeros(n, np.int32)
        for j in range(w):
            above = row[j + 1].copy()
            same = (a[:, i] == b[:, j]) & (a[:, i] > 0)
            row[j + 1] = np.where(same, diagonal + 1, np.maximum(above, row[j]))
            diagonal = above
    return row[w]


class ItemIndex:
    """Latent vectors of the items' windows, grouped around centres."""

    def __init__(self, rules: LeakRules, ids: list[int], tokens: list[np.ndarray], tails: list[np.ndarray], idf: np.ndarray, basis: np.ndarray):
        self.rules, self.ids, self.tails = rules, np.array(ids), tails
        each = [windows(t, rules.window, rules.item_stride, rules.least) for t in tokens]
        self.tokens = np.concatenate(each) if each else np.zeros((0, rules.window), np.int32)
        self.owner = np.repeat(np.arange(len(ids)), [len(e) for e in each])
        self.foreign2 = float(idf.max() ** 2) if len(idf) else 1.0
        self.space = np.vstack([np.zeros((1, basis.shape[1])), idf[:, None] * basis])  # row 0: a foreign word
        if rules.by_counts:
            self._postings(len(idf))
        else:
            self._group()

    def _postings(self, size: int) -> None:
        """Items of each word, and the windows of each item."""
        at = self.tokens > 0  # -1 fills up short items
        pairs = np.unique((self.tokens.astype(np.int64) + self.owner[:, None] * (size + 1))[at])
        item, word = pairs // (size + 1), pairs % (size + 1)
        order = np.argsort(word, kind="stable")
        self.items_of, self.word_at = item[order], np.searchsorted(word[order], np.arange(size + 2))
        self.window_at = np.searchsorted(self.owner, np.arange(len(self.ids) + 1))
        self.tail_of = np.array([i for i, t in enumerate(self.tails) if len(t)], int)
        self.tail_words = np.concatenate([self.tails[i] for i in self.tail_of]) if len(self.tail_of) else np.zeros(0, int)
        self.tail_at = np.cumsum([0, *(len(self.tails[i]) for i in self.tail_of)])[:-1]

    def needs(self, ids: np.ndarray) -> np.ndarray:
        """Words that a document has to share with each item: fewer where it has the item's question or answer line word by word."""
        need = np.full(len(self.ids), self.rules.need)
        if self.rules.least < self.rules.need and len(self.tail_words):
            there = np.zeros(len(self.space), bool)
            there[ids] = True
            every = np.logical_and.reduceat(there[self.tail_words], self.tail_at)
            for i in self.tail_of[every]:
                if _holds(ids, self.tails[i]):
                    need[i] = self.rules.least
        return need

    def _group(self) -> None:
        rules = self.rules
        self.vectors = self.project(self.tokens)
        m = len(self.tokens)
        rng = np.random.default_rng(11)
        picked = rng.choice(m, min(m, rules.centres), replace=False) if m else np.zeros(0, int)
        self.centres = self.vectors[picked]
        near = np.concatenate([np.argmax(self.vectors[lo : lo + 4096] @ self.centres.T, 1) for lo in range(0, m, 4096)]) if m else np.zeros(0, int)
        angle = np.arccos(np.clip(np.einsum("ij,ij->i", self.vectors, self.centres[near]), -1, 1)) if m else np.zeros(0)
        self.groups = [np.flatnonzero(near == c) for c in range(len(picked))]
        self.reach = np.array([angle[g].max() if len(g) else 0.0 for g in self.groups])

    def project(self, tokens: np.ndarray) -> np.ndarray:
        out = np.zeros((len(tokens), self.space.shape[1]), np.float32)
        for lo in range(0, len(tokens), 4096):
            t = tokens[lo : lo + 4096]
            z = self.space[np.maximum(t, 0)].sum(1)
            norm = np.sqrt((z * z).sum(1) + (t == 0).sum(1) * self.foreign2)
            out[lo : lo + 4096] = z / np.maximum(norm, 1e-30)[:, None]
        return out

    def candidates(self, tokens: np.ndarray):
        """(window, item window, cosine) of all with a cosine of cos_min or more."""
        least = self.rules.cos_min - 1e-5
        slack = np.arccos(np.clip(least, -1, 1)) + 1e-3
        q = self.project(tokens)
        found = []
        for lo in range(0, len(q), 4096):
            part = q[lo : lo + 4096]
            angle = np.arccos(np.clip(part @ self.centres.T, -1, 1))
            near = angle <= slack + self.reach
            for c in np.flatnonzero(near.any(0)):
                g, rows = self.groups[c], np.flatnonzero(near[:, c])
                if len(g):
                    cos = part[rows] @ self.vectors[g].T
                    i, j = np.nonzero(cos >= least)
                    found.append((lo + rows[i], g[j], cos[i, j]))
        if not found:
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.float32)
        return tuple(np.concatenate([f[k] for f in found]) for k in range(3))

    def cosines(self, windows_: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the pairs windows_[i], tokens[j]."""
        (i, at_i), (j, at_j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
        x, y = self.project(windows_[i]), self.project(self.tokens[j])
        return np.concatenate([np.zeros(0, np.float32), *(np.einsum("ij,ij->i", x[at_i[lo : lo + 50_000]], y[at_j[lo : lo + 50_000]]) for lo in range(0, len(at_i), 50_000))])

    def shared_windows(self, ids: np.ndarray):
        """(window, item window, shared words) of all pairs of the document's windows and item windows that share `need` words."""
        r = self.rules
        need = self.needs(ids)  # by item
        w = windows(ids, r.window, r.stride, int(need.min(initial=r.need)))
        starts = np.minimum(np.arange(len(w)) * r.stride, max(0, len(ids) - r.window))
        ids = np.pad(ids, (0, max(0, r.window - len(ids))))  # a short document's only window is filled up with foreign words
        foreign = np.concatenate([[0], np.cumsum(ids == 0)])
        known = np.flatnonzero(foreign[starts + r.window] - foreign[starts] <= r.window - need.min(initial=r.need))
        found = [(np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int32))]
        for rows in np.split(known, np.flatnonzero(np.diff(known // PART)) + 1):
            if not len(rows):
                continue
            at = starts[rows] - starts[rows[0]]
            vocabulary, local = np.unique(ids[starts[rows[0]] : starts[rows[-1]] + r.window], return_inverse=True)
            member = np.zeros((len(vocabulary), len(self.ids)), np.uint8)
            for k, word in enumerate(vocabulary):
                if word:
                    member[k, self.items_of[self.word_at[word] : self.word_at[word + 1]]] = 1
            some = np.flatnonzero(member.sum(0, dtype=np.int32))
            near = [some[lo : lo + PART] for lo in range(0, len(some), PART)]
            near = [n[(_counts(member[:, n], local, at, r.window) >= need[n]).any(0)] for n in near]
            place = np.full(len(self.space), len(vocabulary), np.int32)  # of words that the text lacks: an extra row
            place[vocabulary] = np.arange(len(vocabulary))
            place[0] = len(vocabulary)
            item_windows = np.concatenate([np.zeros(0, int), *(np.arange(self.window_at[i], self.window_at[i + 1]) for n in near for i in n)])
            for lo in range(0, len(item_windows), 4 * PART):
                j = item_windows[lo : lo + 4 * PART]
                x, y, size = _compare(local, at, vocabulary, self.tokens[j], place, r, need[self.owner[j]])
                found.append((rows[x], j[y], size))
        return w, *(np.concatenate([f[k] for f in found]) for k in range(3))


#: Windows of a document that are compared with as many items, or four times as many of their windows, at once.
PART = 1_024


def _counts(member: np.ndarray, local: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """How many positions of each window of the text have a word of each column of member (words × columns)."""
    kind = np.uint8 if size < 256 else np.int32  # sums run over, their differences don't
    sums = np.zeros((len(local) + 1, member.shape[1]), kind)
    for k, word in enumerate(local.tolist()):  # whole rows at once; cumsum along this axis is slower
        np.add(sums[k], member[word], out=sums[k + 1])
    return sums[starts + size] - sums[starts]


def _compare(local: np.ndarray, starts: np.ndarray, vocabulary: np.ndarray, b: np.ndarray, place: np.ndarray, rules: LeakRules, need: np.ndarray):
    """(window of the text, row of b, shared words) of all pairs that share need[row of b] words. local: the text in places of the vocabulary."""
    at, every = place[np.maximum(b, 0)], np.arange(len(b))
    where = np.zeros((len(vocabulary) + 1, len(b)), np.uint64)  # bit k: the word is at position k of the window
    for k in range(b.shape[1]):
        where[at[:, k], every] |= np.uint64(1 << k % 64)
    where[-1] = 0
    x, y = np.nonzero(_counts((where != 0).view(np.uint8), local, starts, b.shape[1]) >= need)
    size = np.zeros(len(x), np.int32)
    for lo in range(0, len(x), 50_000):
        i, j = starts[x[lo : lo + 50_000], None] + np.arange(b.shape[1]), y[lo : lo + 50_000]
        if rules.subsequence and b.shape[1] < 64:
            size[lo : lo + 50_000] = _subsequence_bits(local[i], j, where, b.shape[1])
        else:
            size[lo : lo + 50_000] = (longest_subsequence if rules.subsequence else longest_run)(vocabulary[local[i]], b[j])
    hit = size >= need[y]
    return x[hit], y[hit], size[hit]


def _subsequence_bits(local: np.ndarray, j: np.ndarray, where: np.ndarray, width: int) -> np.ndarray:
    """longest_subsequence with a row of its table in the bits of one number (Hyyrö)."""
    row = np.full(len(j), (1 << width) - 1, np.uint64)
    for k in range(local.shape[1]):
        same = row & where[local[:, k], j]
        row = (row + same) | (row - same)
    return width - np.bitwise_count(row & np.uint64((1 << width) - 1)).astype(np.int32)


#: Rows of the vocabulary's matrix that one task adds up.
GRAM_ROWS = 1_024
_ENCODED = "doc_id bigint, present binary, tokens binary"


def word_hashes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, hashes): a 64-bit hash of each word of the text, in order."""

    def run(batches):
        known: dict[str, int] = {}
        for b in batches:
            rows = []
            for t in b.column("text"):
                w = words(t.as_py())
                for x in w:
                    if x not in known:
                        known[x] = word_hash(x)
                rows.append(np.fromiter(map(known.__getitem__, w), np.int64, len(w)).tobytes())
                if len(known) > 1_000_000:
                    known.clear()
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(rows, pa.binary())], names=["doc_id", "hashes"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, hashes binary")


def word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def encode(docs: DataFrame, vocabulary, rules: LeakRules, id_col: str, text_col: str, hashed: bool = False) -> DataFrame:
    """doc_id, the vocabulary numbers in the text once each, and the text in numbers if a window of it can match.

    vocabulary: a broadcast of word → number, or, if the texts come hashed, of (sorted hashes, their numbers).
    """
    allowed = rules.window - rules.least

    def run(batches):
        number = vocabulary.value
        for b in batches:
            present, tokens = [], []
            for t in b.column("text"):
                if hashed:
                    h = np.frombuffer(t.as_py(), np.int64)
                    at = np.minimum(np.searchsorted(number[0], h), len(number[0]) - 1)
                    ids = np.where(number[0][at] == h, number[1][at], 0).astype(np.int32)
                else:
                    w = words(t.as_py())
                    ids = np.fromiter((number.get(x, 0) for x in w), np.int32, len(w))
                present.append(np.unique(ids[ids > 0]).tobytes())
                use = False
                if len(ids) >= rules.least:
                    size = min(rules.window, len(ids))
                    foreign = np.concatenate([[0], np.cumsum(ids == 0)])
                    use = bool((foreign[size:] - foreign[:-size] <= allowed).any())
                tokens.append(ids.tobytes() if use else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(present, pa.binary()), pa.array(tokens, pa.binary())], names=["doc_id", "present", "tokens"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _ENCODED)


def document_frequencies(encoded: DataFrame, size: int) -> np.ndarray:
    """In how many documents each word of the vocabulary is. One sum per partition leaves the executors."""

    def run(batches):
        n = np.zeros(size + 1, np.int64)
        for b in batches:
            for p in b.column("present"):
                n[np.frombuffer(p.as_py() or b"", np.int32)] += 1
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(n[at])], names=["k", "n"])

    out = np.zeros(size)
    for r in encoded.select("present").mapInArrow(run, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r["k"] - 1] = r["n"]
    return out


def latent_basis(passages: DataFrame, idf: np.ndarray, rules: LeakRules) -> np.ndarray:
    """Right singular vectors (vocabulary × rank) of the TF-IDF matrix of the passages' windows, by random projection."""
    size = len(idf)
    r = min(size, rules.rank + 8)
    stride = max(1, rules.window // 2)

    def gram_times(q: np.ndarray) -> np.ndarray:
        shared = passages.sparkSession.sparkContext.broadcast(q)

        def run(batches):
            m, out = shared.value, np.zeros_like(q)
            for b in batches:
                for t in b.column("tokens"):
                    w = windows(np.frombuffer(t.as_py(), np.int32), rules.window, stride, 1)
                    known = np.maximum(w, 0)
                    y = (np.vstack([np.zeros((1, m.shape[1])), idf[:, None] * m])[known]).sum(1)
                    rows, cols = np.nonzero(known)
                    k = known[rows, cols] - 1
                    np.add.at(out, k, idf[k][:, None] * y[rows])
            part = [k for k in range(0, size, GRAM_ROWS) if out[k : k + GRAM_ROWS].any()]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([out[k : k + GRAM_ROWS].tobytes() for k in part], pa.binary())], names=["k", "m"])

        def add(t: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(m.as_py()) for m in t.column("m"))
            return pa.table({"k": t.column("k").slice(0, 1), "m": pa.array([total.tobytes()], pa.binary())})

        # the partitions' matrices are added up on the executors, some rows of the vocabulary in a task; one matrix comes back
        total = np.zeros_like(q)
        for row in passages.mapInArrow(run, "k int, m binary").groupBy("k").applyInArrow(add, "k int, m binary").collect():
            total[row["k"] : row["k"] + GRAM_ROWS] = np.frombuffer(row["m"]).reshape(-1, q.shape[1])
        return total

    q = np.linalg.qr(np.random.default_rng(5).standard_normal((size, r)))[0]
    for _ in range(rules.power_rounds):
        q = np.linalg.qr(gram_times(q))[0]
    small = q.T @ gram_times(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return q @ vectors[:, np.argsort(-values)[: rules.rank]]


def _search(encoded: DataFrame, index) -> DataFrame:
    def run(batches):
        ix: ItemIndex = index.value
        r = ix.rules
        for b in batches:
            item, doc, cosine, shared, tail = [], [], [], [], []
            docs, blocks, n = [], [], 0

            def settle(i, j, size, cos, at, texts):
                hit = size >= r.least
                pair = np.column_stack([ix.owner[j[hit]], at[i[hit]], size[hit], np.round(cos[hit] * 1e6).astype(np.int64)])
                if len(pair):
                    pair = pair[np.lexsort((-pair[:, 3], -pair[:, 2], pair[:, 1], pair[:, 0]))]
                    pair = pair[np.append(True, (np.diff(pair[:, :2], axis=0) != 0).any(1))]
                    for o, d_, s, c in pair.tolist():
                        want = ix.tails[o]
                        there = None if not len(want) else _holds(texts[d_], want)
                        if s < r.need and not there:
                            continue
                        item.append(int(ix.ids[o]))
                        doc.append(d_)
                        shared.append(s)
                        cosine.append(min(1.0, c / 1e6))
                        tail.append(there)

            rows = list(zip(b.column("doc_id").to_pylist(), b.column("tokens")))
            texts = {}
            for k, (d, t) in enumerate(rows):
                ids = np.frombuffer(t.as_py(), np.int32)
                if r.by_counts:
                    w, i, j, size = ix.shared_windows(ids)
                    settle(i, j, size, ix.cosines(w, i, j), np.full(len(w), d), {d: ids})
                    continue
                w = windows(ids, r.window, r.stride, r.need)
                w = w[(w == 0).sum(1) <= r.window - r.need]
                if len(w):
                    texts[d] = ids
                    docs.append(np.full(len(w), d))
                    blocks.append(w)
                    n += len(w)
                if n and (n >= 16_384 or k == len(rows) - 1):
                    w, at = np.concatenate(blocks), np.concatenate(docs)
                    i, j, cos = ix.candidates(w)
                    size = np.zeros(len(i), np.int32)
                    for lo in range(0, len(i), 50_000):
                        x, y = w[i[lo : lo + 50_000]], ix.tokens[j[lo : lo + 50_000]]
                        size[lo : lo + 50_000] = np.where(((x == y) & (x > 0)).all(1), r.need, 0)
                    settle(i, j, size, cos, at, texts)
                    docs, blocks, n, texts = [], [], 0, {}
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(cosine, pa.float64()), pa.array(shared, pa.int32()), pa.array(tail, pa.bool_())], names=["item_id", "doc_id", "cosine", "shared", "answer_found"])

    return encoded.filter("tokens is not null").select("doc_id", "tokens").mapInArrow(run, "item_id bigint, doc_id bigint, cosine double, shared int, answer_found boolean")


def _holds(text: np.ndarray, part: np.ndarray) -> bool:
    if len(part) > len(text):
        return False
    return bool((np.lib.stride_tricks.sliding_window_view(text, len(part)) == part).all(1).any())


def sample_share(rules: LeakRules, kept: int) -> int:
    """Hashes, of 2 ** 30, that put a document into the sample; kept: documents with a window that can match, as only these are taken."""
    return int(min(1.0, rules.sample_docs / max(1, kept)) * (1 << 30))


def find_leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules(), id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """docs, items(item_id, item_text) → (item_id, doc_id, cosine, shared, answer_found), one row per leaked item and document.

    answer_found: whether the document also has the item's question or answer line word by word; null if the item has none.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "leakage")
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "item_text").filter("item_id is not null and item_text is not null").distinct()
    chars = items.agg(F.sum(F.length("item_text"))).first()[0] or 0
    blocks = chars // BLOCK_CHARS + 1
    found = None
    hashes = scratch.keep(word_hashes(docs, id_col, text_col), "hashes") if blocks > 1 else None
    for k in range(blocks):
        rows = sorted(items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect())  # at most about BLOCK_CHARS
        texts = [words(r["item_text"]) for r in rows]
        number = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
        tokens = [np.array([number[w] for w in t], np.int32) for t in texts]
        tails = [np.array([number[w] for w in words(r["item_text"][m[-1].end() :])], np.int32) if (m := list(_TAIL.finditer(r["item_text"]))) else np.zeros(0, np.int32) for r in rows]
        if hashes is None:
            coded = encode(docs, spark.sparkContext.broadcast(number), rules, id_col, text_col)
        else:
            pairs = sorted((word_hash(w), i) for w, i in number.items()) or [(0, 0)]
            coded = encode(hashes, spark.sparkContext.broadcast(tuple(np.array(c, np.int64) for c in zip(*pairs))), rules, "doc_id", "hashes", True)
        encoded = scratch.keep(coded, f"encoded-{k}")
        n_docs = encoded.count()
        idf = np.log((n_docs + 1) / (document_frequencies(encoded, len(number)) + 1)) + 1
        kept = encoded.filter("tokens is not null")
        share = sample_share(rules, kept.count())
        sample = kept.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) <= share).select("tokens").limit(2 * rules.sample_docs)
        own = spark.createDataFrame([(t.tobytes(),) for t in tokens if len(t)], "tokens binary")
        passages = scratch.keep(own.union(sample).repartition(4), f"passages-{k}")
        basis = latent_basis(passages, idf, rules) if len(number) else np.zeros((0, 1))
        index = spark.sparkContext.broadcast(ItemIndex(rules, [r["item_id"] for r in rows], tokens, tails, idf, basis))
        part = _search(encoded, index)
        found = part if found is None else found.union(part)
    best = F.max(F.struct("shared", "cosine"))
    return found.groupBy("item_id", "doc_id").agg(best.alias("b"), F.max("answer_found").alias("answer_found")).select("item_id", "doc_id", "b.cosine", "b.shared", "answer_found")


#: Passages that are alike but not equal: 16 of 24 words in order, or 14 and the item's question or answer line.
PARAPHRASE = LeakRules(window=24, need=16, subsequence=True, answer_need=14)

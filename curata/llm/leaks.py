"""Problem 2: passages of held-out items inside training texts, by latent semantic retrieval.

1. Stretches. The vocabulary is that of the items. A run of words that a text shares with an item consists of vocabulary words only, so a text's
   candidate passages are its longest stretches of vocabulary words. The same pass counts in how many fields of the whole corpus each term occurs.
2. Latent space. Stretches are cut into tiles of `tile` words; tiles and the items' own windows are TF-IDF vectors, and one pass over them gives
   A'A times a random matrix, summed by Spark: a randomised SVD whose driver part has the size of the items' vocabulary.
3. Search. Every distinct tile is projected and looked up among the projected distinct windows of the items: windows are filed under the signs of
   latent coordinates, a tile looks into its own cell and the cells across its nearest borders, and the cosine decides. Equal word sets have
   equal vectors, so with a tile of half the required run or less (rounded down) none is lost.
4. Verification. The runs of the required length that hold a tile with a candidate are compared with those of the items, word by word. What many items
   have in common costs no more than what one has: a tile is a candidate once, and items are told apart only where a whole run agrees.

Paraphrases are subsequences over a whole field, which no cosine bounds. They are searched for by the words in common instead: a subsequence is never
longer than their number, so a field with too few of them is left out without loss, and all others are measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from . import shingles as S
from .near import _batches

#: Characters of items that are searched for at once: what is broadcast has about 60 bytes for each. A larger set is worked off in parts of this size.
ITEM_CHARS = 2_000_000
RANK, OVERSAMPLE, SIGN_BITS = 48, 16, 16
FOREIGN = -1
#: Pairs of a text and an item whose common words are counted at once.
PAIRS_AT_ONCE = 1_000_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def _spaced(text: str | None) -> str:
    """The words of a text, each between blanks; empty without words."""
    words = [w.lower() for w in S.WORD.findall(text or "")]
    return f" {' '.join(words)} " if words else ""


def run_hashes(terms: np.ndarray, run: int) -> np.ndarray:
    """A 64-bit number of each word sequence of `run` words."""
    out = np.zeros(max(0, len(terms) - run + 1), np.uint64)
    for k in range(run if len(out) else 0):
        out = out * _PRIME + terms[k : k + len(out)].astype(np.uint64)
    return out


class Items:
    """A block of items on the driver and in each worker: vocabulary, word lists, distinct windows, runs."""

    def __init__(self, rows: list[tuple[int, str | None, str | None]], run: int, tile: int):
        self.run, self.tile = run, tile
        self.ids = [r[0] for r in rows]
        #: Words of each answer between blanks; empty for answers under three characters.
        self.answers = [_spaced(r[2]) if len((r[2] or "").strip()) >= 3 else "" for r in rows]
        self.vocabulary: dict[str, int] = {}
        self.words = [np.array([self.vocabulary.setdefault(w.lower(), len(self.vocabulary)) for w in S.WORD.findall(r[1] or "")], np.int32) for r in rows]
        flat = np.concatenate(self.words) if self.words else np.zeros(0, np.int32)
        owner = np.repeat(np.arange(len(self.words)), [len(w) for w in self.words])
        inside = lambda n: np.flatnonzero(owner[: max(0, len(flat) - n + 1)] == owner[n - 1 :])
        long_enough = np.repeat(np.array([len(w) >= run for w in self.words], bool), [len(w) for w in self.words])
        at = inside(tile)
        at = at[long_enough[at]]
        #: Distinct word sets, as sorted terms, of `tile` words in a row, of the items that hold a run at all.
        self.windows = np.unique(np.sort(flat[at[:, None] + np.arange(tile)], axis=1), axis=0) if len(at) else np.zeros((0, tile), np.int32)
        at = inside(run)
        value = run_hashes(flat, run)[at]
        order = np.argsort(value, kind="stable")
        self.flat, self.run_hash, self.run_at, self.run_item = flat, value[order], at[order], owner[at[order]]

    def having(self, term: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, item) for the runs of words that begin at the starts and stand, word by word, in an item."""
        if not len(starts) or not len(self.run_hash):
            return
        value = np.zeros(len(starts), np.uint64)
        for k in range(self.run):
            value = value * _PRIME + term[starts + k].astype(np.uint64)
        left, right = np.searchsorted(self.run_hash, value), np.searchsorted(self.run_hash, value, side="right")
        for p in np.flatnonzero(right > left).tolist():
            own = term[starts[p] : starts[p] + self.run]
            for q in range(left[p], right[p]):
                if np.array_equal(own, self.flat[self.run_at[q] : self.run_at[q] + self.run]):
                    yield int(starts[p]), int(self.run_item[q])


class _Terms(dict):
    """Word as written -> its place in the vocabulary, or FOREIGN; emptied when it is full."""

    def __init__(self, vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, word):
        if len(self) >= S.CACHE_WORDS:
            self.clear()
        value = self[word] = self.vocabulary.get(word.lower(), FOREIGN)
        return value


def stretches(trajectory: DataFrame, items, least: int) -> DataFrame:
    """traj_id, field, terms of every stretch of at least `least` vocabulary words; and, with a null traj_id and field -1, (terms, counts): the
    fields of a part of the corpus in which each term occurs."""

    def run(iterator):
        block = items.value
        terms = _Terms(block.vocabulary)
        size = len(block.vocabulary)
        seen = np.zeros(size, np.int64)
        fields = 0
        get = terms.__getitem__
        for table in _batches(iterator, 5000):
            ids = table["traj_id"].to_pylist()
            for field, column in enumerate(("prompt", "response")):
                counts = np.zeros(len(ids), np.int64)
                flat: list[int] = []
                for k, text in enumerate(table[column].to_pylist()):
                    if text:
                        found = S.WORD.findall(text)
                        counts[k] = len(found)
                        flat.extend(map(get, found))
                term = np.array(flat, np.int64)
                owner = np.repeat(np.arange(len(ids)), counts)
                inside = term >= 0
                fields += int((counts > 0).sum())
                if size and len(term):
                    seen += np.bincount(np.unique(owner[inside] * size + term[inside]) % size, minlength=size)
                edge = np.flatnonzero(np.diff(np.concatenate([[-1], np.where(inside, owner, -1), [-1]])))
                starts = edge[:-1][inside[edge[:-1]]] if len(edge) else edge
                ends = edge[np.searchsorted(edge, starts, side="right")] if len(starts) else starts
                keep = (ends - starts) >= least
                out = [(ids[owner[s]], term[s:e]) for s, e in zip(starts[keep], ends[keep]) if ids[owner[s]] is not None]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([field] * len(out), pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.int64())), pa.nulls(len(out), pa.list_(pa.int64()))], ["traj_id", "field", "terms", "counts"])
        place = np.append(np.flatnonzero(seen), size)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([-1], pa.int32()), pa.array([place], pa.list_(pa.int64())), pa.array([np.append(seen[place[:-1]], fields)], pa.list_(pa.int64()))], ["traj_id", "field", "terms", "counts"])

    return trajectory.select("traj_id", "prompt", "response").mapInArrow(run, "traj_id long, field int, terms array<long>, counts array<long>")


def idf(surveyed: DataFrame, size: int) -> np.ndarray:
    """Smoothed inverse document frequency of each term over all fields of the corpus; at most one row a term reaches the driver."""
    rows = surveyed.where("field = -1").select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n")).toPandas()
    count = np.zeros(size + 1)
    count[rows["terms"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    return np.log((1 + count[size]) / (1 + count[:size])) + 1


def _vectors(tiles: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unit vectors: sums of the rows of `table` of each tile's terms, always in the order of the terms. FOREIGN reads the zero row at the end."""
    out = np.zeros((len(tiles), table.shape[1]))
    for k in range(tiles.shape[1]):
        out += table[tiles[:, k]]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def latent_table(surveyed: DataFrame, items, block: Items, weight: np.ndarray) -> np.ndarray:
    """Rows of idf times the right singular vectors, one for each term and a zero row for foreign words."""
    size, width = len(block.vocabulary), RANK + OVERSAMPLE
    names = [f"c{k}" for k in range(width)]
    spark = surveyed.sparkSession
    omega = np.random.default_rng(7).standard_normal((size, width))
    sketch = spark.sparkContext.broadcast(np.vstack([weight[:, None] * omega, np.zeros(width)]))

    def sums(tiles: np.ndarray, times: np.ndarray) -> np.ndarray:
        image = np.zeros((len(tiles), width))
        for k in range(tiles.shape[1]):
            image += sketch.value[tiles[:, k]]
        image *= times[:, None]
        out = np.zeros((size + 1, width))
        for k in range(tiles.shape[1]):
            order = np.argsort(tiles[:, k], kind="stable")
            term = tiles[order, k]
            first = np.flatnonzero(np.diff(term, prepend=-2))
            out[term[first]] += np.add.reduceat(image[order], first, axis=0) if len(first) else 0
        return out[:size] * weight[:, None]

    def run(iterator):
        out = np.zeros((size, width))
        tile = items.value.tile
        for table in _batches(iterator, 4000):
            column = table["terms"].combine_chunks()
            term, ends = column.flatten().to_numpy(), column.offsets.to_numpy()[1:] - column.offsets.to_numpy()[0]
            whole = np.diff(ends, prepend=0) // tile
            at = np.repeat(ends - np.diff(ends, prepend=0), whole) + (np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)) * tile
            if len(at):
                distinct, n = np.unique(np.sort(term[at[:, None] + np.arange(tile)], axis=1), axis=0, return_counts=True)
                out += sums(distinct, n)
        used = np.flatnonzero(np.abs(out).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), *(pa.array(out[used, k]) for k in range(width))], ["term", *names])

    parts = surveyed.where("field >= 0").select("terms").mapInArrow(run, "term long, " + ", ".join(f"{n} double" for n in names))
    total = parts.groupBy("term").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    image = sums(block.windows, np.ones(len(block.windows)))
    image[total["term"].to_numpy(np.int64)] += total[names].to_numpy(np.float64)
    core = omega.T @ image
    value, vector = np.linalg.eigh((core + core.T) / 2)
    kept = value > value.max() * 1e-10
    basis, _, _ = np.linalg.svd(image @ (vector[:, kept] / np.sqrt(value[kept])), full_matrices=False)
    return np.vstack([weight[:, None] * basis[:, :RANK], np.zeros(min(RANK, basis.shape[1]))])


class Cells:
    """The items' distinct windows under the signs of their first latent coordinates."""

    def __init__(self, block: Items, table: np.ndarray):
        self.table = table
        #: About one window a cell: the more windows, the more signs.
        self.bits = min(SIGN_BITS, table.shape[1], max(4, len(block.windows).bit_length()))
        vectors = _vectors(block.windows, table).astype(np.float32)
        codes = self.code(vectors)
        order = np.argsort(codes, kind="stable")
        self.vectors = vectors[order]
        self.codes, self.starts = np.unique(codes[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(codes))

    def code(self, vectors: np.ndarray) -> np.ndarray:
        return ((vectors[:, : self.bits] > 0) << np.arange(self.bits)).sum(axis=1)

    def near(self, tiles: np.ndarray, cosine: float, borders: int) -> np.ndarray:
        """Whether each tile has a window of that cosine at least, in its own cell or across so many of its nearest borders."""
        vectors = _vectors(tiles, self.table).astype(np.float32)
        own = self.code(vectors)
        border = np.argsort(np.abs(vectors[:, : self.bits]), axis=1)[:, : min(borders, self.bits)]
        probes = [own]
        for k in range(border.shape[1]):
            probes += [p ^ (1 << border[:, k]) for p in list(probes)]
        out = np.zeros(len(tiles), bool)
        for code in probes:
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            open_ = np.flatnonzero((self.codes[at] == code) & ~out)
            start, n = self.starts[at[open_]], self.ends[at[open_]] - self.starts[at[open_]]
            for k in range(int(n.max(initial=0))):
                still = (n > k) & ~out[open_]
                t, w = open_[still], start[still] + k
                out[t[np.einsum("ij,ij->i", vectors[t], self.vectors[w]) >= cosine]] = True
        return out


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """Longest run of consecutive equal words."""
    best = np.zeros(len(b) + 1, np.int64)
    out = 0
    for x in a:
        best[1:] = np.where(b == x, best[:-1] + 1, 0)
        out = max(out, int(best.max(initial=0)))
    return out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    row = np.zeros(len(b) + 1, np.int64)
    for x in a:
        step = np.where(b == x, row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(np.maximum(step, row[1:]))
    return int(row[-1])


def _search(surveyed: DataFrame, items, cells, cosine: float, borders: int) -> DataFrame:
    """traj_id, item_id of every stretch and item with a run of the required length around a candidate tile."""

    def run(iterator):
        block, index = items.value, cells.value
        n, size = block.run, block.tile
        for table in _batches(iterator, 4000):
            column = table["terms"].combine_chunks()
            term, ends = column.flatten().to_numpy().astype(np.int32), column.offsets.to_numpy()[1:] - column.offsets.to_numpy()[0]
            lengths = np.diff(ends, prepend=0)
            starts = ends - lengths
            whole = lengths // size
            owner = np.repeat(np.arange(len(lengths)), whole)
            at = np.repeat(starts, whole) + (np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)) * size
            at, owner = np.concatenate([at, ends - size]), np.concatenate([owner, np.arange(len(lengths))])  # side by side, and one at the end
            tiles = np.sort(term[at[:, None] + np.arange(size)], axis=1)
            distinct, which = np.unique(tiles, axis=0, return_inverse=True)
            hit = index.near(distinct, cosine, borders)[which.ravel()]
            first, o = at[hit], owner[hit]
            begin = (first[:, None] + np.arange(size - n, 1)).ravel()  # the runs that hold the tile
            o = np.repeat(o, n - size + 1)
            begin = np.unique(begin[(begin >= starts[o]) & (begin + n <= ends[o])])
            ids = table["traj_id"].to_numpy()
            out = sorted({(int(ids[np.searchsorted(ends, p, side="right")]), block.ids[item]) for p, item in block.having(term, begin)})
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(2)], ["traj_id", "item_id"])

    spread = surveyed.where("field >= 0").select("traj_id", "terms").repartition(surveyed.sparkSession.sparkContext.defaultParallelism)
    return spread.mapInArrow(run, "traj_id long, item_id long")


def item_blocks(eval_item: DataFrame, run: int, tile: int) -> Iterator[Items]:
    """All items, block by block; of items under one id the first is taken. A block has about ITEM_CHARS characters."""
    ordered = eval_item.where("item_id is not null").groupBy("item_id").agg(F.min(F.struct("text", "answer")).alias("x")).select("item_id", "x.text", "x.answer")
    chars = ordered.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // ITEM_CHARS))
    for b in range(blocks):
        part = ordered if blocks == 1 else ordered.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        yield Items(sorted(((r[0], r[1], r[2]) for r in part.collect()), key=lambda r: r[0]), run, tile)


def candidates(trajectory: DataFrame, eval_item: DataFrame, run: int, tile: int, cosine: float, borders: int) -> DataFrame:
    """traj_id, item_id of the pairs with a run in common, for all items, block by block."""
    spark = trajectory.sparkSession
    out = None
    for block in item_blocks(eval_item, run, tile):
        items = spark.sparkContext.broadcast(block)
        surveyed = materialise(stretches(trajectory, items, run), "stretches")
        if len(block.windows):
            table = latent_table(surveyed, items, block, idf(surveyed, len(block.vocabulary)))
            found_ = _search(surveyed, items, spark.sparkContext.broadcast(Cells(block, table)), cosine, borders)
        else:
            found_ = spark.createDataFrame([], "traj_id long, item_id long")
        out = found_ if out is None else out.unionByName(found_)
    return out


def found(trajectory: DataFrame, eval_item: DataFrame, run: int = 12) -> DataFrame:
    """traj_id, item_id: prompt or response has at least `run` consecutive words in common with the item's text.

    Null texts count as empty and have no passages; rows with a null id are left out; of items under one id the one whose text comes first counts;
    repeated rows give one row; other columns aren't read; without rows or items the result is empty.
    """
    return candidates(trajectory, eval_item, run, run // 2, 0.99, 1).distinct()


class Bags:
    """The items' words filed for a search by the number of words in common.

    A word's second, third ... occurrence counts as a word of its own. Of an item of n words a subsequence of `least` * n, `need` words, has to be
    reached. Without the need // 2 words that most items have, need - need // 2 of its other words are still in common, so only those are filed.
    """

    def __init__(self, block: Items, least: float):
        size = len(block.vocabulary)
        self.most = np.zeros(size, np.int64)
        counted = []
        for w in block.words:
            term, n = np.unique(w, return_counts=True)
            self.most[term] = np.maximum(self.most[term], n)
            counted.append((term, n))
        self.base = np.cumsum(self.most) - self.most
        total = int(self.most.sum())
        tokens = [np.repeat(self.base[term], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) for term, n in counted]
        usual = np.bincount(np.concatenate(tokens), minlength=total) if total else np.zeros(0, np.int64)
        need = [int(np.ceil(least * len(t) - 1e-9)) for t in tokens]
        filed = [t[np.argsort(usual[t], kind="stable")][: len(t) - k // 2] for t, k in zip(tokens, need)]
        self.required = np.array([max(1, k - k // 2) for k in need], np.int64)
        token = np.concatenate(filed) if filed else np.zeros(0, np.int64)
        order = np.argsort(token, kind="stable")
        self.item = np.repeat(np.arange(len(filed)), [len(f) for f in filed])[order]
        self.starts = np.searchsorted(token[order], np.arange(total + 1))
        self.places: dict[int, dict[int, int]] = {}

    def near(self, term: np.ndarray, owner: np.ndarray, texts: int) -> Iterator[tuple[int, int]]:
        """Pairs (text, item) with enough words in common; term and owner without foreign words, ordered by owner."""
        items = len(self.required)
        step = max(1, PAIRS_AT_ONCE // max(1, items))
        for first in range(0, texts if items else 0, step):
            s, e = np.searchsorted(owner, [first, first + step])
            key = np.sort((owner[s:e] - first) * len(self.most) + term[s:e])
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            place = np.arange(len(key)) - np.repeat(start, np.diff(np.append(start, len(key))))
            text, t = key // len(self.most), key % len(self.most)
            keep = place < self.most[t]
            token, text = self.base[t[keep]] + place[keep], text[keep]
            n = self.starts[token + 1] - self.starts[token]
            item = self.item[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.starts[token], n)]
            common = np.bincount(np.repeat(text, n) * items + item, minlength=step * items).reshape(-1, items)
            a, b = np.nonzero(common >= self.required)
            yield from zip((a + first).tolist(), b.tolist())

    def subsequence(self, terms: list[int], item: int, words: np.ndarray) -> int:
        """common_subsequence, by the bits of one whole number for the item's words."""
        if item not in self.places:
            self.places[item] = {}
            for k, w in enumerate(words.tolist()):
                self.places[item][w] = self.places[item].get(w, 0) | 1 << k
        places, full = self.places[item], (1 << len(words)) - 1
        row = full
        for x in terms:
            if x in places:
                hit = row & places[x]
                row = ((row + hit) | (row - hit)) & full
        return len(words) - row.bit_count()


def _close(trajectory: DataFrame, items, bags, share: float) -> DataFrame:
    """traj_id, item_id, verbatim, share, has_answer: pairs with a run in common, and of each row the pairs that count as paraphrases."""

    def run(iterator):
        block, index = items.value, bags.value
        terms = _Terms(block.vocabulary)
        get = terms.__getitem__
        for table in _batches(iterator, 2000):
            ids, responses = table["traj_id"].to_pylist(), table["response"].to_pylist()
            texts = [t or "" for pair in zip(table["prompt"].to_pylist(), responses) for t in pair]  # text k is of row k // 2
            flat: list[int] = []
            counts = np.zeros(len(texts), np.int64)
            for k, text in enumerate(texts):
                found = S.WORD.findall(text)
                counts[k] = len(found)
                flat.extend(map(get, found))
            term, owner = np.array(flat, np.int64), np.repeat(np.arange(len(texts)), counts)
            runs = np.flatnonzero(owner[: max(0, len(owner) - block.run + 1)] == owner[block.run - 1 :])
            verbatim = {(int(owner[p]) // 2, item) for p, item in block.having(term, runs)}
            inside = term >= 0
            term, owner = term[inside], owner[inside]
            at = np.searchsorted(owner, np.arange(len(texts) + 1))
            best: dict[tuple[int, int], float] = {}
            for t, item in index.near(term, owner, len(texts)):
                if (t // 2, item) not in verbatim:
                    words = block.words[item]
                    reached = index.subsequence(term[at[t] : at[t + 1]].tolist(), item, words) / len(words)
                    best[t // 2, item] = max(reached, best.get((t // 2, item), 0.0))
            out = [(ids[r], block.ids[item], True, 0.0, False) for r, item in sorted(verbatim)]
            for (r, item), reached in sorted(best.items()):
                if reached >= share * 2 / 3:
                    answer = block.answers[item]
                    has = bool(answer) and answer in _spaced(responses[r])
                    if reached >= share or has:
                        out.append((ids[r], block.ids[item], False, reached, has))
            names = ["traj_id", "item_id", "verbatim", "share", "has_answer"]
            types = [pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

    rows = trajectory.where("traj_id is not null").select("traj_id", "prompt", "response")
    return rows.mapInArrow(run, "traj_id long, item_id long, verbatim boolean, share double, has_answer boolean")


def paraphrases(trajectory: DataFrame, eval_item: DataFrame, share: float = 0.6) -> DataFrame:
    """traj_id, item_id, share (longest common subsequence over the item's words), has_answer, for pairs that share no verbatim passage.

    The subsequence is that of the whole prompt or the whole response, whichever is longer. A pair counts from `share` on, or from two thirds of that
    if the item's answer, of three characters or more, stands in the response.
    """
    context = trajectory.sparkSession.sparkContext
    out = None
    for block in item_blocks(eval_item, 12, 6):
        close = _close(trajectory, context.broadcast(block), context.broadcast(Bags(block, share * 2 / 3)), share)
        out = close if out is None else out.unionByName(close)
    best = out.groupBy("traj_id", "item_id").agg(*(F.max(c).alias(c) for c in ("verbatim", "share", "has_answer")))
    return best.where(~F.col("verbatim")).select("traj_id", "item_id", "share", "has_answer")

"""Language-model scores by a class bigram model with exchange clustering.

Every word seen ``least_count`` times or more is an item of its own; rarer words, and words never seen, are grouped by
their ending. Exchange clustering puts the items into classes. A first exchange on the driver places a fixed number of
items, one by one: the most frequent words, and the endings. Its classes are where all items start. From there the
exchange goes on over all items in Spark: the pairs of the corpus, kept as numbers in blocks of items, give each item its
counts beside every class, and each item moves to the class that gives the class pairs the highest likelihood. The class of
each item, one small number, is sent to the tasks, so a pass reads the blocks without a shuffle. The items of
a pass move at once, so it counts only if the likelihood has risen. A pass moves a quarter of the items, by a hash, and the
next ones a smaller share where the likelihood fell. Passes end when a round over all items would add less, at
the rate of the last pass, than ``least_gain`` for each token. A word's probability after another is the transition of their classes times the word's share of its class;
transitions are mixed with the classes' own shares, and each class keeps half a count for a word it has not seen.

All training documents are counted: words, and pairs of words. Texts are taken in parts of a bounded number of words, and a
part numbers its distinct words once: only these are joined with a table of all words, never its tokens. A text's score needs
the count and the class of each of its words. The most frequent ones (a bounded list) are sent to the scan; the others of a
part are looked up by the join, and the part's texts, kept as numbers, are then scored as arrays. As a part asks for a word
once, no key of that join is large, however often a document is copied.

Cases: a NULL or empty text is the end token alone; a NULL id counts as empty text for the folds;
without training words every word is unknown; repeated rows are scored each; texts are read whole.
"""

from __future__ import annotations

import gc
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantpulse.llm.common import Recent, discard, fold, written

END = b""  # no word is empty
#: Words that a Python worker counts before it hands them on, and that it remembers the items of; bounds its memory only.
REMEMBERED = 300_000
#: Words that are sent to the scan with their counts.
FREQUENT = 50_000
#: Texts handled at a time by the first exchange.
_AT_ONCE = 500
#: Items whose gains are worked out at a time; their arrays should fit a processor's cache.
_MOVED = 50
#: Tokens that a Python worker numbers, or counts the pairs of, before it hands them on; bounds its memory only.
_TOKENS = 2_000_000
#: The smallest share of the items that moves at once is one in so many.
_SHARES = 16
#: Items in a block, on average.
_ITEMS = 8_192


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case, then the end token."""
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


@dataclass(frozen=True)
class Items:
    """Which item a word is: a word of its own, or a group by ending. The end token is the last item."""

    own: dict[bytes, int]
    groups: int

    def __len__(self) -> int:
        return len(self.own) + self.groups + 1

    def of(self, word: bytes) -> int:
        if word == END:
            return len(self) - 1
        at = self.own.get(word)
        return len(self.own) + self.group(word) if at is None else at

    def group(self, word: bytes) -> int:
        """By the last two characters; marks and accents are among them, so a group keeps to a style or language."""
        tail = word[-6:].decode("utf-8", "ignore")[-2:]
        return zlib.crc32(tail.encode()) % self.groups


def word_counts(training: DataFrame) -> DataFrame:
    """``word`` (bytes) and ``n`` over all training texts; the end token is the empty word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(tokens(text))
                if len(seen) > REMEMBERED:
                    yield _rows(seen)
                    seen = Counter()
        if seen:
            yield _rows(seen)

    def _rows(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    return training.select("text").mapInArrow(counted, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def item_bigrams(training: DataFrame, items: Items) -> np.ndarray:
    """How often each item follows each, over all training texts; the end token also begins a text."""
    size = len(items)
    sent = training.sparkSession.sparkContext.broadcast(items)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Recent(sent.value.of, REMEMBERED)
        total = np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, _AT_ONCE):
                line = [size - 1]
                for text in batch.column(0).slice(at, _AT_ONCE).to_pylist():
                    line.extend(map(known.__getitem__, tokens(text)))
                line = np.array(line, dtype=np.int64)
                total += np.bincount(line[:-1] * size + line[1:], minlength=size * size)
        yield from _as_rows(dict(enumerate(total.reshape(size, size))))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, np.ndarray] = {}
        for batch in batches:
            for item, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(counts, dtype=np.int64)
                rows[item] = rows[item] + own if item in rows else own
        yield from _as_rows(rows)

    def _as_rows(rows: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([
            pa.array(list(rows), pa.int32()), pa.array([r.tobytes() for r in rows.values()], pa.binary())], names=["item", "counts"])

    schema = "item int, counts binary"
    parts = training.select("text").mapInArrow(counted, schema)
    out = np.zeros((size, size), dtype=np.int64)
    # One row for each item, whose number is a parameter.
    for row in parts.repartition("item").mapInArrow(added, schema).toLocalIterator():
        out[row["item"]] += np.frombuffer(bytes(row["counts"]), dtype=np.int64)
    return out


def exchange(bigrams: np.ndarray, classes: int, passes: int | None = None) -> np.ndarray:
    """Class of each item. The last item (the end token) is a class of its own, the last one.

    Every move adds to the likelihood, so the passes come to an end by themselves; ``passes`` ends them before.
    """
    size = len(bigrams)
    classes = min(classes, size)
    often = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    order = np.argsort(-often[:-1], kind="stable")
    label = np.empty(size, dtype=np.int64)
    label[order] = np.arange(size - 1) % max(1, classes - 1)
    label[-1] = classes - 1

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1.0))

    one = np.eye(classes)[label]
    pairs = one.T @ bigrams.astype(float) @ one
    # A gain has to be larger than what the rounding of n log n makes up, or moves could go on for ever.
    least = 1e-6 + 1e-14 * float(f(pairs.sum()))
    for _ in count() if passes is None else range(passes):
        moved = 0
        for w in order:
            one = np.eye(classes)[label]
            here, right, left, self_ = label[w], bigrams[w] @ one, bigrams[:, w] @ one, float(bigrams[w, w])
            right[here] -= self_
            left[here] -= self_
            base = pairs.copy()
            base[here] -= right
            base[:, here] -= left
            base[here, here] -= self_
            # Wherever the item goes, it follows and is followed by the same classes.
            rows, columns = base.sum(axis=1) + left, base.sum(axis=0) + right
            # What joining each class adds to the sum of n log n over class pairs, less that over classes.
            gain = (f(base + right) - f(base)).sum(axis=1) + (f(base.T + left) - f(base.T)).sum(axis=1)
            own = np.diag(base)
            gain += f(own + right + left + self_) - f(own + right) - f(own + left) + f(own)
            gain -= f(rows + right.sum() + self_) - f(rows) + f(columns + left.sum() + self_) - f(columns)
            gain[-1] = -np.inf
            to = int(np.argmax(gain))
            if gain[to] <= gain[here] + least:
                continue
            moved += 1
            label[w] = to
            base[to] += right
            base[:, to] += left
            base[to, to] += self_
            pairs = base
        if not moved:
            break
    return label


def key_of_group(group: int) -> bytes:
    """The item that stands for all rare words of an ending; no word has a tab."""
    return b"\t%d" % group


def vocabulary(counts: DataFrame, items: Items, least_count: int) -> DataFrame:
    """``word, n, item``: the item is the word itself, or its ending's if it was seen less than ``least_count`` times."""
    sent = counts.sparkSession.sparkContext.broadcast(items)

    @F.pandas_udf("binary")
    def ending(words: pd.Series) -> pd.Series:
        return words.map(lambda w: key_of_group(sent.value.group(bytes(w))))

    often = (F.col("n") >= least_count) | (F.col("word") == F.lit(END))
    return counts.where(often).withColumn("item", F.col("word")).unionByName(
        counts.where(~often).withColumn("item", ending("word")))


def word_pairs(training: DataFrame, items: Items) -> DataFrame:
    """``first, second, n``, and the number of each word's ending: words next to each other, counted within parts.

    The end token also begins a text.
    """
    sent = training.sparkSession.sparkContext.broadcast(items)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {END: 0}
        line = [0]
        for batch in batches:
            for text in batch.column(0).to_pylist():
                line.extend([number.setdefault(w, len(number)) for w in tokens(text)])
                if len(line) > _TOKENS or len(number) > REMEMBERED:
                    yield from _rows(number, line)
                    number, line = {END: 0}, [0]
        yield from _rows(number, line)

    def _rows(number: dict[bytes, int], line: list[int]) -> Iterator[pa.RecordBatch]:
        codes, words = np.array(line, dtype=np.int64), pa.array(list(number), pa.binary())
        endings = np.array([sent.value.group(w) for w in number], dtype=np.int32)
        pairs, times = np.unique((codes[:-1] << 32) | codes[1:], return_counts=True)
        for at in range(0, len(pairs), 50_000):
            first, second = pairs[at:at + 50_000] >> 32, pairs[at:at + 50_000] & 0xFFFFFFFF
            yield pa.RecordBatch.from_arrays(
                [words.take(pa.array(first)), words.take(pa.array(second)), pa.array(endings[first]), pa.array(endings[second]),
                 pa.array(times[at:at + 50_000], pa.int64())],
                names=["first", "second", "first_ending", "second_ending", "n"])

    return training.select("text").mapInArrow(
        counted, "first binary, second binary, first_ending int, second_ending int, n long")


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """What :func:`tokens` finds in all texts, without the end tokens, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    some = pc.binary_length(words).to_numpy() > 0
    ends = np.concatenate([[0], np.cumsum(some)])[lists.offsets.to_numpy()]
    return words.filter(pa.array(some)).cast(pa.binary()), np.diff(ends)


def _numbered_texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[pa.Array], pa.Array, np.ndarray]]:
    """Rows in parts of some ``most`` words and a bounded size, one longer text aside: the first columns, the part's distinct
    words (the end token is the first) and all texts (the last column) in order, as the numbers of their words."""
    rows, found, tokens_, bytes_ = [], [], 0, 0

    def part() -> tuple[list[pa.Array], pa.Array, np.ndarray]:
        number = pa.concat_arrays([pa.array([END], pa.binary()), *(f.dictionary for f, _ in found)]).dictionary_encode()
        place, at, line, end = number.indices.to_numpy()[1:], 0, np.zeros(tokens_, dtype=np.int32), 0
        for codes, size in found:
            to = np.arange(len(codes)) + np.repeat(np.arange(len(size)), size)
            line[end + to] = place[at + codes.indices.to_numpy()]
            at, end = at + len(codes.dictionary), end + len(codes) + len(size)
        return [pa.concat_arrays(c) for c in zip(*rows)], number.dictionary, line

    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        total = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(), dtype=np.int64)
        at = 0
        while at < len(texts):
            # A text has at most one word in two bytes.
            before = int(total[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + 2 * most, "right")))
            size = int(total[to - 1]) - before
            if found and (tokens_ > most or bytes_ + size > 16 * most):
                yield part()
                rows, found, tokens_, bytes_ = [], [], 0, 0
                pa.default_memory_pool().release_unused()  # other tasks of the executor need it
            words, each = _split(texts.slice(at, to - at))
            rows.append([c.slice(at, to - at) for c in batch.columns[:-1]])
            found.append((words.dictionary_encode(), each))
            tokens_, bytes_, at = tokens_ + len(words) + len(each), bytes_ + size, to
    if found:
        yield part()
    rows, found = [], []
    pa.default_memory_pool().release_unused()


def _endings(items: Items, words: pa.Array) -> np.ndarray:
    """The group of each word; it goes by the last bytes, so it is worked out once for each ending."""
    tails = pc.binary_slice(words, -6).dictionary_encode()
    groups = np.array([items.group(t) for t in tails.dictionary.to_pylist()], dtype=np.int32)
    return groups[tails.indices.to_numpy()]


def word_parts(training: DataFrame, items: Items = Items({}, 1)) -> DataFrame:
    """All training texts in one scan, in parts of a bounded number of tokens.

    A part has a row for each of its words (``part, at, word, n``), and one with its pairs of neighbours (the places of
    both words and how often they meet) and with the ending of each word. The end token also begins a text.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        for _, words, line in _numbered_texts(batches, _TOKENS):
            size = len(words)
            before = np.concatenate([[0], line[:-1]]).astype(np.int64)
            keys, times = np.unique(before << 32 | line, return_counts=True)
            n = np.bincount(line, minlength=size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(size, part)), pa.array(np.arange(size, dtype=np.int32)), words, pa.array(n),
                 *[pa.nulls(size, pa.binary())] * 2], names=names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()),
                 pa.array([_packed(keys >> 32, keys & 0xFFFFFFFF, times)], pa.binary()),
                 pa.array([_planes(_endings(items, words))], pa.binary())], names=names)
            part += 1

    names = ["part", "at", "word", "n", "pairs", "endings"]
    return training.select("text").mapInArrow(counted, "part long, at int, word binary, n long, pairs binary, endings binary")


def _packed(own: np.ndarray, other: np.ndarray, n: np.ndarray) -> bytes:
    """Entries as compressed bytes: two numbers below 2^31 and a count of each."""
    return b"".join(len(x).to_bytes(8, "little") + x for x in map(_planes, (own, other, n)))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    out, at = [], 0
    for kind in ("<i4", "<i4", "<i8"):
        end = at + 8 + int.from_bytes(data[at : at + 8], "little")
        out.append(_from_planes(data[at + 8 : end]).astype(kind))
        at = end
    return tuple(out)


def _planes(x: np.ndarray) -> bytes:
    """Whole numbers as compressed bytes, in the smallest type and the lowest byte of all of them first."""
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    small = np.min_scalar_type(min(low, -high - 1) if low < 0 else high)
    planes = x.astype(small.newbyteorder("<")).view(np.uint8).reshape(len(x), small.itemsize)
    whole = b"".join(planes[:, k].tobytes() for k in range(small.itemsize))
    return small.char.encode() + len(x).to_bytes(8, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def _from_planes(data: bytes) -> np.ndarray:
    small, size = np.dtype(data[:1].decode()).newbyteorder("<"), int.from_bytes(data[1:9], "little")
    whole = pa.decompress(data[9:], decompressed_size=small.itemsize * size, codec="zstd", asbytes=True) if size else b""
    planes = np.empty((size, small.itemsize), dtype=np.uint8)
    for k in range(small.itemsize):
        planes[:, k] = np.frombuffer(whole, np.uint8, size, k * size)
    return planes.view(small).ravel()


def numbered(items: DataFrame) -> tuple[DataFrame, int]:
    """``items`` (one row for each ``item``) with its number ``id``, and the number of blocks: an item's block is the
    number modulo that, and its place in the block the number divided by it."""
    blocks = 1 + items.count() // _ITEMS
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))
    place = F.row_number().over(Window.partitionBy(block).orderBy("item")) - 1
    return items.withColumn("id", (place * blocks + block).cast("int")), blocks


_ENTRIES = "block int, side int, data binary"


def _dealt(first: np.ndarray, second: np.ndarray, n: np.ndarray, blocks: int) -> pa.Table:
    """Pairs of items by blocks: those of the first items (side 0), and those of the second ones (side 1)."""
    rows = []
    first, second = first.astype(np.int32), second.astype(np.int32)
    for side, own, other in ((0, first, second), (1, second, first)):
        block = (own % blocks).astype(np.min_scalar_type(blocks))  # small numbers are sorted by counting
        order = np.argsort(block, kind="stable")
        ends = np.cumsum(np.bincount(block, minlength=blocks))
        for b in np.unique(block).tolist():
            at = order[ends[b - 1] if b else 0 : ends[b]]
            rows.append((b, side, _packed(own[at] // blocks, other[at], n[at])))
    block, side, data = zip(*rows) if rows else ((), (), ())
    return pa.table([pa.array(block, pa.int32()), pa.array(side, pa.int32()), pa.array(data, pa.binary())],
                    names=["block", "side", "data"])


def looked_up(parts: DataFrame, table: DataFrame) -> tuple[DataFrame, str]:
    """``part, at`` of each word of the parts that ``table`` has, and what that says of it. Written, so that the join is off
    the disk before the texts or pairs of the parts are moved."""
    words = parts.where(F.col("word").isNotNull()).select("part", "at", "word").join(table, "word").drop("word")
    out = written(words, "word-places", "zstd")
    del words
    _let_go(parts.sparkSession)
    return out


def part_entries(parts: DataFrame, ids: DataFrame, blocks: int, of_ending: np.ndarray = np.zeros(1, np.int32)) -> DataFrame:
    """The pairs of all parts, dealt to the blocks of their items. ``ids``: the item's number ``id`` of each ``word`` that is
    an item of its own; ``of_ending``: the number of each ending, for the other words."""
    return placed_entries(parts, looked_up(parts, ids.select("word", "id"))[0], blocks, of_ending)


def placed_entries(parts: DataFrame, words: DataFrame, blocks: int, of_ending: np.ndarray) -> DataFrame:
    """Like :func:`part_entries`, from the words of the parts with their numbers: ``part, at, id``."""

    def dealt(words: pa.Table, pairs: pa.Table) -> pa.Table:
        number = of_ending[_from_planes(pairs.column("endings")[0].as_py())].astype(np.int64)
        number[words.column("at").to_numpy()] = words.column("id").to_numpy()
        first, second, n = _unpacked(pairs.column("pairs")[0].as_py())
        keys, n = _added((number[first] << 32) | number[second], n)
        return _dealt(keys >> 32, keys & 0xFFFFFFFF, n, blocks)

    pairs = parts.where(F.col("pairs").isNotNull()).select(F.col("part").alias("of"), "pairs", "endings")
    return words.groupBy("part").cogroup(pairs.groupBy("of")).applyInArrow(dealt, _ENTRIES)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(n[order], starts)


def block_pairs(entries: DataFrame, items: DataFrame, blocks: int) -> DataFrame:
    """One row for each block of items: pairs in which they come first, those in which they come second, and hashes."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            block = own % blocks
            found = np.unique(block).tolist()
            at = [np.flatnonzero(block == b) for b in found]
            yield pa.RecordBatch.from_arrays([
                pa.array(found, pa.int32()), pa.array([2] * len(found), pa.int32()),
                pa.array([_packed(own[i] // blocks, 0 * own[i], values[i]) for i in at], pa.binary())], names=["block", "side", "data"])

    def merged(group: pa.Table) -> pa.Table:
        side, data = group.column("side").to_pylist(), group.column("data").to_pylist()
        columns = []
        for k in range(3):
            found = [_unpacked(d) for s, d in zip(side, data) if s == k]
            own, other, n = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 3
            keys, n = _added((own.astype(np.int64) << 32) | other, n)
            columns.append(pa.array([_packed(keys >> 32, keys & 0xFFFFFFFF, n)], pa.binary()))
        return pa.table([group.column("block").combine_chunks()[:1], *columns], names=["block", "right", "left", "hashes"])

    own = items.select("id", F.xxhash64("item")).mapInArrow(hashes, _ENTRIES)
    return entries.unionByName(own).groupBy("block").applyInArrow(merged, "block int, right binary, left binary, hashes binary")


def label_pairs(pairs: DataFrame, blocks: int, label: np.ndarray, size: int) -> np.ndarray:
    """Counts of pairs of labels, given the label of each item's number: at most the square of the number of labels."""
    sent = pairs.sparkSession.sparkContext.broadcast(label)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size)  # whole numbers are exact in it up to 2^53
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                own, other, n = _unpacked(data.as_py())
                cell = sent.value[own.astype(np.int64) * blocks + block].astype(np.int64) * size + sent.value[other]
                total += np.bincount(cell, n, size * size)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(total[cells].astype(np.int64))], names=["cell", "n"])

    cells = pairs.select("block", "right").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
    sent.destroy()
    return out.reshape(size, size)


def item_pairs(training: DataFrame, words: DataFrame, items: Items) -> DataFrame:
    """``first, second, n`` over items: the words' pairs with each word replaced by its item.

    Only words that are items of their own are joined; they are written first, so that Spark knows their size and sends
    them to all tasks only where they are small enough.
    """
    out = word_pairs(training, items)
    own, _ = written(words.where(F.col("item") == F.col("word")).select("word", "item"), "word-own")
    for side in ("first", "second"):
        ending = F.concat(F.lit("\t"), F.col(f"{side}_ending").cast("string")).cast("binary")
        out = out.join(own.select(F.col("word").alias(side), F.col("item").alias("own")), side, "left").withColumn(
            side, F.coalesce("own", ending)).drop("own")
    return out.groupBy("first", "second").agg(F.sum("n").alias("n"))


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def worth(pairs: np.ndarray) -> float:
    """The part of the log likelihood that depends on the classes, from the counts of class pairs."""
    return float(_f(pairs).sum() - _f(pairs.sum(axis=0)).sum() - _f(pairs.sum(axis=1)).sum())


def gains(pairs: np.ndarray, here: np.ndarray, right: np.ndarray, left: np.ndarray, self_: np.ndarray) -> np.ndarray:
    """What each item adds to :func:`worth` in each class, all other items staying where they are.

    Rows are items: their class, how often each class follows and precedes them (themselves not counted), and how often
    they follow themselves. Only the classes beside an item are looked at. The last class is the end token's alone.
    """
    rows, size = np.arange(len(here)), len(pairs)
    total = np.zeros((len(here), size))

    def beside(table: np.ndarray, near: np.ndarray, far: np.ndarray) -> None:
        """Adds the growth of the class pairs on one side; ``table[c, j]`` counts class c beside class j."""
        k, j = np.nonzero(near)
        if not len(k):
            return
        base = table[:, j].T.copy()
        base[np.arange(len(k)), here[k]] -= near[k, j]
        own = np.flatnonzero(j == here[k])
        base[own] -= far[k[own]]
        base[own, here[k[own]]] -= self_[k[own]]
        grown = _f(base + near[k, j][:, None]) - _f(base)
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        total[k[starts]] += np.add.reduceat(grown, starts, axis=0)

    beside(pairs, right, left)
    beside(pairs.T, left, right)
    own = np.tile(np.diag(pairs).astype(float), (len(here), 1))
    own[rows, here] -= right[rows, here] + left[rows, here] + self_
    total += _f(own + right + left + self_[:, None]) - _f(own + right) - _f(own + left) + _f(own)
    for sums, times in ((pairs.sum(axis=1), right.sum(axis=1) + self_), (pairs.sum(axis=0), left.sum(axis=1) + self_)):
        without = np.tile(sums.astype(float), (len(here), 1))
        without[rows, here] -= times
        total -= _f(without + times[:, None]) - _f(without)
    total[:, -1] = -np.inf
    return total


def _classed(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs with the classes of both items. Spark sends the classes to all tasks only where they are small."""
    first = labels.select(F.col("item").alias("first"), F.col("class").alias("first_class"))
    second = labels.select(F.col("item").alias("second"), F.col("class").alias("second_class"))
    return pairs.join(first, "first").join(second, "second")


def class_pairs(pairs: DataFrame, labels: DataFrame, classes: int) -> np.ndarray:
    """Counts of class pairs: at most the square of the number of classes, whatever the input."""
    out = np.zeros((classes, classes))
    for r in _classed(pairs, labels).groupBy("first_class", "second_class").agg(F.sum("n").alias("n")).collect():
        out[r["first_class"], r["second_class"]] = r["n"]
    return out


def _rounds_hash(hashes: np.ndarray, turn: int) -> np.ndarray:
    """``F.xxhash64("item", F.lit(turn))`` from the hashes of the items alone."""
    p1, p2, p3, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
    x = hashes.astype(np.int64).view(np.uint64) + p5 + np.uint64(4)
    x = x ^ np.uint64(turn * int(p1) & 0xFFFFFFFFFFFFFFFF)
    x = ((x << np.uint64(23)) | (x >> np.uint64(41))) * p2 + p3
    x = (x ^ (x >> np.uint64(33))) * p2
    x = (x ^ (x >> np.uint64(29))) * p3
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def moved(pairs: DataFrame, blocks: int, label: np.ndarray, now: np.ndarray, turn: int = 0, shares: int = 1) -> DataFrame:
    """``id, class`` of the items that a pass moves, each to the class where it adds most, given the class pairs ``now``.

    One of ``shares`` equal shares of the items may move, another one each ``turn``.
    """
    classes = len(now)
    least = 1e-6 + 1e-14 * abs(float(_f(now).sum()))
    sent = pairs.sparkSession.sparkContext.broadcast(label)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *data in zip(*(c for c in batch.columns)):
                yield from placed(block.as_py(), *(_unpacked(d.as_py()) for d in data))

    def placed(block: int, after: tuple, before: tuple, hashes: tuple) -> Iterator[pa.RecordBatch]:
        place = hashes[0].astype(np.int64)
        free = np.mod(_rounds_hash(hashes[2], turn // shares) + turn, shares) == 0
        free &= sent.value[place * blocks + block] != classes - 1
        which = place[free]
        row = np.full(int(place.max(initial=-1)) + 1, -1)
        row[which] = np.arange(len(which))
        width = 2 * classes + 1
        table = np.zeros(len(which) * width)
        for shift, (own, other, n) in ((0, after), (classes, before)):
            at = row[own]
            on = at >= 0
            own, other, n, at = own[on].astype(np.int64), other[on], n[on], at[on]
            table += np.bincount(at * width + shift + sent.value[other], n, len(table))
            if not shift:
                same = own * blocks + block == other
                table[at[same] * width + width - 1] = n[same]
        table = table.reshape(-1, width)
        for start in range(0, len(which), _MOVED):
            some, ids = table[start : start + _MOVED], which[start : start + _MOVED] * blocks + block
            here = sent.value[ids].astype(np.int64)
            right, left, self_ = some[:, :classes], some[:, classes:-1], some[:, -1]
            rows = np.arange(len(ids))
            right[rows, here] -= self_
            left[rows, here] -= self_
            gain = gains(now, here, right, left, self_)
            to = gain.argmax(axis=1)
            goes = gain[rows, to] > gain[rows, here] + least
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[goes], pa.int32()), pa.array(to[goes], pa.int32())], names=["id", "class"])

    return pairs.select("block", "right", "left", "hashes").mapInArrow(places, "id int, class int")


def exchanged(pairs: DataFrame, blocks: int, label: np.ndarray, classes: int, least_gain: float) -> tuple[np.ndarray, np.ndarray]:
    """Passes over the items until one adds less than ``least_gain`` for each token: classes by item number, class pairs.

    The driver and each worker hold one small number for each item: its class.
    """
    now = label_pairs(pairs, blocks, label, classes)
    turn, shares = 0, 4
    while now.any():
        moves = moved(pairs, blocks, label, now, turn, shares).toArrow()
        after = label.copy()
        after[moves.column("id").to_numpy()] = moves.column("class").to_numpy()
        then = label_pairs(pairs, blocks, after, classes)
        gain = worth(then) - worth(now)
        if gain > 0:
            label, now = after, then
        if gain * shares < least_gain * now.sum() and (gain > 0 or shares == _SHARES):
            break
        turn += 1
        if gain <= 0:
            turn, shares = 0, shares * 4
    return label, now


def _by_number(items: DataFrame, column: str, size: int) -> np.ndarray:
    """A column of ``items`` as an array by number, in the smallest type for numbers below ``size``."""
    found = items.select("id", column).toArrow()
    ids = found.column("id").to_numpy()
    out = np.zeros(int(ids.max(initial=-1)) + 1, dtype=np.min_scalar_type(size))
    out[ids] = found.column(column).to_numpy()
    return out


def _looked_up(label: np.ndarray, of: DataFrame) -> DataFrame:
    """``of`` with the ``class`` of each ``id``."""
    sent = of.sparkSession.sparkContext.broadcast(label)

    @F.pandas_udf("int")
    def at(ids: pd.Series) -> pd.Series:
        return pd.Series(sent.value[ids.to_numpy()].astype("int32"))

    return of.withColumn("class", at("id"))


def clustered(
    pairs: DataFrame, labels: DataFrame, classes: int, least_gain: float, folder: str | None = None
) -> tuple[DataFrame, str, np.ndarray]:
    """Like :func:`exchanged`, from pairs and classes by item: classes by item, their folder, class pairs."""
    spark = pairs.sparkSession
    items, blocks = numbered(labels)
    items, items_at = written(items, "word-items")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _dealt(*(c.to_numpy().astype(np.int64) for c in batch.columns), blocks).to_batches()

    first, second = (items.select(F.col("item").alias(c), F.col("id").alias(f"{c}_id")) for c in ("first", "second"))
    entries = pairs.join(first, "first").join(second, "second").select("first_id", "second_id", "n").mapInArrow(dealt, _ENTRIES)
    packed, packed_at = written(block_pairs(entries, items, blocks), "word-pairs")
    label, now = exchanged(packed, blocks, _by_number(items, "class", classes), classes, least_gain)
    out, at = written(_looked_up(label, items).select("item", "class"), "word-classes")
    for old in (items_at, packed_at, folder):
        if old is not None:
            discard(spark, old)
    return out, at, now


def _let_go(spark: SparkSession) -> None:
    """Spark deletes the files of shuffles that the driver's collector finds out of use."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@dataclass(frozen=True)
class Model:
    """What the scan needs: the first items, the classes of the frequent words and of the endings, and for each pair of
    classes the log10 of the transition less that of the second class's size. ``numerator`` has log10(n + 0.5) of the
    frequent words. All of it has a fixed size."""

    items: Items
    ending_class: np.ndarray
    step: np.ndarray
    frequent: dict[bytes, int]
    frequent_class: np.ndarray
    numerator: np.ndarray
    train_tokens: int
    types: int


def trained(
    docs: DataFrame, classes: int = 64, words: int = 384, groups: int = 384, mixing: float = 200.0,
    least_count: int = 5, least_gain: float = 0.02,
) -> tuple[Model, DataFrame]:
    """The model learnt from the training folds of ``docs``, and the written table of words: ``word, n, class``.

    ``words`` and ``groups`` are the items of the first exchange; every word seen ``least_count`` times takes part in the
    passes after it. ``least_gain`` is in natural logarithms for each token (0.02: two per cent of the perplexity).
    """
    spark = docs.sparkSession
    training = docs.where(fold() != 1)
    parts, parts_at = written(word_parts(training, Items({}, groups)), "word-parts", "zstd")
    counts = parts.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
    counts, counts_at = written(counts, "word-counts")
    _let_go(spark)
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # The least count that at most ``FREQUENT`` words reach, from the number of words of each count.
    words_of = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    reach = F.sum("words").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    least = words_of.select("n", reach.alias("reach")).where(F.col("reach") <= FREQUENT).agg(F.min("n")).first()[0]
    least = least if least is not None else 2**62
    top = counts.where(F.col("n") >= F.lit(least)).toPandas()
    top = top.assign(word=[bytes(w) for w in top["word"]]).sort_values(["n", "word"], ascending=[False, True])
    items = Items({w: i for i, w in enumerate([w for w in top["word"] if w != END][:words])}, groups)
    sent = spark.sparkContext.broadcast(items)

    @F.pandas_udf("int")
    def start(keys: pd.Series) -> pd.Series:
        known = sent.value
        return keys.map(bytes).map(lambda k: len(known.own) + int(k[1:]) if k[:1] == b"\t" else known.of(k)).astype("int32")

    often = (F.col("n") >= least_count) | (F.col("word") == F.lit(END))
    endings = spark.range(groups).select(F.concat(F.lit("\t"), F.col("id").cast("string")).cast("binary"), F.lit(0).cast("long"))
    named, blocks = numbered(counts.where(often).select(F.col("word").alias("item"), "n").union(endings))
    named, named_at = written(named.withColumn("first", start("item")), "word-numbers")
    ending = F.substring("item", 1, 1) == F.lit(b"\t")
    of_ending = np.zeros(groups, dtype=np.int32)
    for row in named.where(ending).select("item", "id").collect():  # their number is a parameter
        of_ending[int(bytes(row["item"])[1:])] = row["id"]
    # Words of their own are joined by word; a part knows the endings of the others. The entries are written before they
    # are dealt, so that what led to them is off the disk by then.
    places, places_at = looked_up(parts, named.where(~ending).select(F.col("item").alias("word"), "id"))
    entries, entries_at = written(placed_entries(parts, places, blocks, of_ending), "word-entries")
    for folder in (parts_at, places_at):
        discard(spark, folder)
    _let_go(spark)
    pairs, pairs_at = written(block_pairs(entries, named, blocks), "word-pairs")
    discard(spark, entries_at)
    _let_go(spark)

    at_first = _by_number(named, "first", len(items))
    first = exchange(label_pairs(pairs, blocks, at_first, len(items)), classes)
    size = int(first.max()) + 1
    begin = first[at_first].astype(np.min_scalar_type(size))
    labels, between = exchanged(pairs, blocks, begin, size, least_gain)
    label = labels[of_ending].astype(np.int64)

    def by_ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes_ = label[_endings(Items({}, groups), batch.column(0))].astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(classes_)], names=["word", "n", "class"])

    own = _looked_up(labels, named.where(~ending)).select(F.col("item").alias("word"), "n", "class")
    rare = counts.where(~often).select("word", "n").mapInArrow(by_ending, "word binary, n long, class int")
    known, _ = written(own.unionByName(rare), "word-table")

    types = np.zeros(size)
    for row in known.groupBy("class").agg(F.count(F.lit(1)).alias("types")).collect():
        types[row["class"]] = row["types"]
    top = known.where(F.col("n") >= F.lit(least)).toPandas()
    for folder in (counts_at, named_at, pairs_at):
        discard(spark, folder)
    _let_go(spark)

    sizes = between.sum(axis=0)
    # Only a class that holds an ending can meet a word it has not seen; it keeps one place for it.
    open_ = np.isin(np.arange(size), label)
    share = (sizes + 1.0) / (sizes.sum() + size)
    move = (between + mixing * share) / (between.sum(axis=1, keepdims=True) + mixing)
    step = np.log10(move) - np.log10(sizes + 0.5 * (types + open_) + 1e-300)
    frequent = {bytes(w): i for i, w in enumerate(top["word"])}
    return Model(
        items, label, step, frequent, top["class"].to_numpy(dtype=np.int64),
        np.log10(top["n"].to_numpy(dtype=np.int64) + 0.5), int(total[0]), int(total[1])), known


def scored(docs: DataFrame, model: Model, known: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The scan numbers the words of each part of the texts, and knows the frequent ones. The others are joined by word, once
    for each part; a part's words and texts then meet in one task, which works out the scores as arrays.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    size = len(model.step)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        frequent = pa.array(list(m.frequent), pa.binary())
        part = TaskContext.get().partitionId() << 32
        for (ids,), words, line in _numbered_texts(batches, _TOKENS):
            place = pc.fill_null(pc.index_in(words, frequent), -1).to_numpy()
            rare = place < 0
            kind = m.ending_class[_endings(m.items, words)]
            kind[0] = size - 1
            kind[~rare] = m.frequent_class[place[~rare]]
            asked = np.flatnonzero(rare).astype(np.int32)
            n = len(asked)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part)), pa.array(asked), words.take(pa.array(asked)), pa.nulls(n, pa.list_(pa.int64())),
                 *[pa.nulls(n, pa.binary())] * 3], names=names)
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary()), ids,
                 *[pa.array([_planes(x)], pa.binary()) for x in (line, place + 1, kind)]], names=names)
            part += 1

    names = ["part", "at", "word", "ids", "line", "place", "kind"]
    asked, _ = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        coded, "part long, at int, word binary, ids array<long>, line binary, place binary, kind binary"), "word-requests", "zstd")

    def summed(words: pa.Table, texts: pa.Table) -> pa.Table:
        m: Model = sent.value
        ids = texts.column("ids")[0].values
        line, place, kind = (_from_planes(texts.column(c)[0].as_py()).astype(np.int32) for c in ("line", "place", "kind"))
        numerator = np.concatenate([[np.log10(0.5)], m.numerator])[place]
        seen = place > 0
        if words.num_rows:
            at = words.column("at").to_numpy()
            seen[at] = True
            kind[at] = words.column("class").to_numpy()
            numerator[at] = np.log10(words.column("n").to_numpy() + 0.5)
        ends = np.flatnonzero(line == 0) + 1
        starts = np.concatenate([[0], ends[:-1]])
        kinds = kind[line]
        steps = m.step[np.concatenate([[size - 1], kinds[:-1]]), kinds]
        return pa.table([
            ids, pa.array(ends - starts), pa.array(np.add.reduceat(seen[line].astype(np.int64), starts)),
            pa.array(np.add.reduceat(numerator[line], starts)), pa.array(np.add.reduceat(steps, starts)),
        ], names=["doc_id", "n_tokens", "n_known", "numerators", "steps"])

    words, _ = looked_up(asked, known)
    texts = asked.where(F.col("line").isNotNull()).select(F.col("part").alias("of"), "ids", "line", "place", "kind")
    by_row = words.groupBy("part").cogroup(texts.groupBy("of")).applyInArrow(
        summed, "doc_id long, n_tokens long, n_known long, numerators double, steps double")
    below = F.lit(float(model.train_tokens) + 0.5 * (model.types + 1))
    return by_row.select(
        "doc_id", (fold() == 1).alias("held_out"), "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("numerators") - F.col("n_tokens") * F.log10(below)).alias("base_score"),
        (F.col("numerators") + F.col("steps")).alias("score"))


def perplexity(scores: DataFrame) -> DataFrame:
    """``held_out``, and the perplexity of the base and of the model over all tokens of these rows."""
    tokens_ = F.sum("n_tokens")
    return scores.groupBy("held_out").agg(*[
        F.pow(F.lit(10.0), -F.sum(c) / tokens_).alias(name) for c, name in (("base_score", "base"), ("score", "model"))])

"""Token counts by byte-pair merging, without building any token.

A text is cut into the same stretches as the tokenizer cuts it. In each stretch the adjacent pair
of lowest rank is merged first, the leftmost of equal ones. The pairs wait in a heap and the
symbols are a doubly linked list, so a stretch of n bytes takes n log n steps; a pair that has
meanwhile lost a side is skipped when it is popped. The count is the number of bytes less the
number of merges.

Stretches repeat all the time, so each Python worker remembers the counts of recent ones.

Cases: a NULL or empty text has 0 bytes and 0 tokens; repeated rows are counted each; other
columns are ignored. Texts are never cut.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantpulse.llm.common import Recent, kept

#: White space as the tokenizer sees it, and its rule for cutting texts.
SPACE = r"\t-\r \x85\xa0  -     　"
STRETCH = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
#: Held per Python worker; bounds its memory only.
REMEMBERED = 300_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the others for the characters from 256 on.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


def count_after_merging(symbols: list[int], merges: dict[int, int]) -> int:
    """Number of symbols left when no adjacent pair can be merged any more.

    ``merges`` has ``rank << 16 | merged symbol`` for each ``left << 16 | right``. The list of
    symbols is used up.
    """
    left = n = len(symbols)
    after = [*range(1, n), -1]
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        m = merges.get(symbols[i] << 16 | symbols[i + 1])
        if m is not None:
            heap.append((m, i))
    heapq.heapify(heap)
    while heap:
        m, i = heapq.heappop(heap)
        j = after[i]
        # A symbol that was merged away is -1, which no pair has.
        if j < 0 or merges.get(symbols[i] << 16 | symbols[j]) != m:
            continue
        symbols[i], symbols[j] = m & 0xFFFF, -1
        left -= 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            m = merges.get(symbols[i] << 16 | symbols[k])
            if m is not None:
                heapq.heappush(heap, (m, i))
        h = before[i]
        if h >= 0:
            m = merges.get(symbols[h] << 16 | symbols[i])
            if m is not None:
                heapq.heappush(heap, (m, h))
    return left


class BytePairCounter:
    """Counts the tokens of texts under one byte-level BPE vocabulary (its JSON text)."""

    def __init__(self, description: str):
        model = json.loads(description)
        if model["model"]["type"] != "BPE" or (model["pre_tokenizer"] or {}).get("type") != "ByteLevel":
            raise ValueError("a byte-level BPE vocabulary is needed")
        if model["normalizer"] or model["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("vocabularies that change the text first are not supported")
        special = model["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("special tokens that take their surroundings are not supported")
        vocabulary = model["model"]["vocab"]
        self._byte = [vocabulary[c] for c in byte_letters()]
        self._merges = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self._merges.setdefault(vocabulary[a] << 16 | vocabulary[b], rank << 16 | vocabulary[a + b])
        names = sorted((re.escape(t["content"]) for t in special), key=len, reverse=True)
        self._special = re.compile("|".join(names)) if names else None
        self._cut = regex.compile(STRETCH)
        self._crowded = re.compile(r"\s\s|\A\s|\s\Z")
        self._stretch = Recent(self._stretch_count, REMEMBERED)
        self._word = Recent(self._word_count, REMEMBERED)

    def _stretch_count(self, stretch: str) -> int:
        byte = self._byte
        return count_after_merging([byte[b] for b in stretch.encode()], self._merges)

    def _word_count(self, word: str) -> int:
        return self._plain(" " + word)

    def _plain(self, text: str) -> int:
        return sum(map(self._stretch.__getitem__, self._cut.findall(text)))

    def _part(self, text: str) -> int:
        # Where single blanks stand between words, no stretch crosses the front of a blank, so
        # the words with their blanks are counted one by one.
        if not text or self._crowded.search(text):
            return self._plain(text)
        first, *words = text.split(" ")
        return self._plain(first) + sum(map(self._word.__getitem__, words))

    def __call__(self, text: str) -> int:
        if self._special is None:
            return self._part(text)
        parts = self._special.split(text)
        return len(parts) - 1 + sum(map(self._part, parts))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, read: Callable[[str], str] | None = None) -> DataFrame:
    """Bytes, tokens and whether there are more than ``limit`` tokens, for each row.

    ``tokenizer`` is the path of a byte-level BPE description. The driver reads it and sends its
    text to the workers (a vocabulary has a fixed size), which need no file.
    """
    if read is None:
        with open(tokenizer, encoding="utf-8") as file:
            description = file.read()
    else:
        description = read(tokenizer)
    sent = docs.sparkSession.sparkContext.broadcast(description)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = kept(("tokens", hash(sent.value)), lambda: BytePairCounter(sent.value))
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            tokens = [count(t) for t in texts]
            # The id is passed on as it came: by way of pandas, a NULL would turn all of a batch into doubles.
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        counted, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

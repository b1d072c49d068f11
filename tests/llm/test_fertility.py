import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
from pyspark.sql import functions as F

from plantpulse.llm.fertility import MEASURES, bands, judged, plain_counts, repeated_words, script
from plantpulse.llm.queries import queries

from .helpers import AWKWARD, FOLDER, clashing, nothing, table

WORD = re.compile("[^\x20\x09-\x0D]+")
FILES = (public.path("piece_bpe_32k.model"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN)


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            marked |= set(range(i, i + 8))
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(marked)


def failed(counts):
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


def lower_median(values):
    return sorted(values)[(len(values) + 1) // 2 - 1]


def verdicts(docs):
    """Kept or not for each (text, language), from exact medians over distinct texts."""
    from tokenizers import Tokenizer
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=FILES[0])
    other = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    found = {}
    for text, lang in docs:
        if not failed(plain(text)):
            ids = pieces.encode(text)
            share = np.array(list(Counter(ids).values())) / len(ids)
            found[text, lang] = (len(ids).bit_length(), *[round(1000 * float(m)) for m in (
                len(text) / len(ids), len(text) / len(other.encode(text, add_special_tokens=False).ids),
                sum(map(pieces.is_byte, ids)) / len(ids), -(share * np.log2(share)).sum())])
    kept = dict.fromkeys(found, True)
    for i in range(1, 5):
        groups = defaultdict(list)
        for (_, lang), m in found.items():
            groups[lang, m[0]].append(m[i])
        middle = {g: lower_median(v) for g, v in groups.items()}
        common = 1.4826 * lower_median([abs(x - middle[g]) for g, v in groups.items() for x in v])
        for (text, lang), m in found.items():
            g = (lang, m[0])
            own, n = 1.4826 * lower_median([abs(x - middle[g]) for x in groups[g]]), len(groups[g])
            width = max((n * own**2 + 10 * common**2) / (n + 10), common**2 / 4) ** 0.5
            if abs(m[i] - middle[g]) > 4 * width:
                kept[text, lang] = False
    return kept


def test_query_equals_plain_version(spark):
    docs = table("documents")
    kept = verdicts([(d["text"], d["lang"]) for d in docs])
    want = {d["doc_id"]: (*plain(d["text"]), failed(plain(d["text"])), kept.get((d["text"], d["lang"]), False)) for d in docs}
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op13_fertility_rules"](spark, FOLDER).collect()}
    assert got == want and 0 < sum(v[-1] for v in want.values()) < len(want)


def test_junk_goes_and_clean_documents_stay(spark):
    rows = queries()["op13_fertility_rules"](spark, "/root/testdata/sf0.01").toPandas()
    quality = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    both = rows.merge(quality, on="doc_id")
    good, bad = (both[(both.quality == q) & ~both.base_failed].kept.mean() for q in (1, 0))
    assert good > 0.97 and bad < 0.3


def test_repeated_windows():
    for words, window in (("a b c a b c a b", 3), ("x " * 30, 8), ("a b c d", 8), ("a b c d e a b c d e f", 5), ("q w q w q", 2)):
        w = words.encode().split()
        marked = set()
        times = Counter(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                marked |= set(range(i, i + window))
        assert repeated_words(w, window) == len(marked)


def test_awkward_rows(spark):
    rows = judged(clashing(spark), *FILES).collect()
    shown = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert shown == Counter((d[0], *plain(d[1]), failed(plain(d[1]))) for d in AWKWARD)
    assert all(plain_counts(d[1] or "") == plain(d[1]) for d in AWKWARD)
    assert not any(r.kept for r in rows if r.base_failed)
    assert judged(nothing(spark), *FILES).count() == 0
    assert {script("Привет"), script("abc"), script("12 !")} == {"Cyrillic", "Latin", "none"}


def test_copies_do_not_move_the_bands(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    from plantpulse.llm.fertility import measured

    first = docs.orderBy("doc_id").limit(1)
    copies = first.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("n")
    get = lambda df: {tuple(r) for r in bands(measured(df, *FILES)).select("speech", "length", "measure", "middle", "width").collect()}
    assert get(docs) == get(docs.unionByName(copies))
    assert {r[2] for r in get(docs)} == set(MEASURES)

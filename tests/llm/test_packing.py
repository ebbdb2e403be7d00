import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadkit.llm.packing import best_fit, op7_best_fit_packing, pack, reduce_by_dominance, solve


def optimum(items, room):
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b >= items[i]:
                k = bins.index(b)
                bins[k] -= items[i]
                go(i + 1, bins)
                bins[k] += items[i]
        bins.append(room - items[i])
        go(i + 1, bins)
        bins.pop()
    go(0, [])
    return best[0]


def one_by_one(items, room):
    bins = []
    for x in sorted(items, reverse=True):
        fit = [i for i, b in enumerate(bins) if b >= x]
        if fit:
            bins[min(fit, key=lambda i: bins[i])] -= x
        else:
            bins.append(room - x)
    return len(bins)


def test_dominance_keeps_an_optimal_packing_and_counts_match_single_steps():
    rng = random.Random(1)
    for _ in range(600):
        room = rng.choice([10, 20, 33])
        items = [rng.randint(1, room) for _ in range(rng.randint(1, 8))]
        counts = Counter(items)
        fixed, rest = reduce_by_dominance(counts, room)
        assert sum(t for _, t in fixed) + optimum(list(Counter(rest).elements()), room) == optimum(items, room)
        assert sum(t for _, t in best_fit(counts, room)) == one_by_one(items, room)
        used = Counter()
        for pattern, times in solve(counts, room):
            assert sum(x * n for x, n in pattern) <= room and times > 0
            for x, n in pattern:
                used[x] += n * times
        assert used == counts


def check(got, docs, capacity):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], "<u4")
            want[d, k, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    frame = op7_best_fit_packing(spark, SMALL)
    assert frame.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = frame.collect()
    n = check(got, docs, 2048)
    assert n <= one_by_one([r.length for r in got], 2048)


def test_odd_rows(spark):
    docs = [(None, None), (3, ""), (3, "a b"), (3, "a b"), (4, "w " * 50_000)] + [(i, "same words here") for i in range(200)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, length int")
    got = pack(frame).collect()
    assert check(got, docs, 2048) == -(-sum(r.length for r in got) // 2048)
    assert check(pack(frame, capacity=7).collect(), docs, 7) > 0
    assert pack(frame.filter(F.lit(False))).count() == 0

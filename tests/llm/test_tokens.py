import random

import public_tokenizers
from conftest import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loadkit.llm.tokens import TOKENIZER, WordCounts, chunk_map, compose, count_text, op6_token_counts, token_counts

PATH = public_tokenizers.path(TOKENIZER)
HARD = ["Hello <|endoftext|> it's <|ENDOFTEXT|> a_b  12é", "", " ", "''s 's'S'T 'RE x're !'s 'llo", "a\x1cb \x85c\xa0d",
        "Σς ΑΣ İI ﬁ é ́x ½ Ⅷ ² १२ 你好 \U0001f642\U0001f44d\U0001f3fd",
        "x" * 3000 + " " + "é" * 500, "<|startoftext|><|endoftext|>x<|startoftext|>", "don't we'll they'd i'm you've",
        " a　b ﻿z ​q", "ǅ ß ŉ ΐ ʼn"]


def random_texts(n):
    rng = random.Random(5)
    out = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzéèñ'12 .,!<|>ABZ\t\n") for _ in range(rng.randint(0, 60))) for _ in range(n)]
    blocks = [(32, 0x3000), (0x10000, 0x1FFFF), (0x3000, 0xD000)]
    return out + ["".join(chr(rng.randrange(*rng.choice(blocks))) for _ in range(rng.randint(0, 40))) for _ in range(n // 5)]


def test_counts_equal_the_library_in_any_chunking():
    library, counts = Tokenizer.from_file(PATH), WordCounts(PATH)
    texts = HARD + random_texts(1500)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [count_text(counts, t) for t in texts] == want
    for size in (1, 3, 7):
        assert [count_text(counts, t, size) for t in texts[:300]] == want[:300]


def test_chunk_maps_compose_associatively():
    counts = WordCounts(PATH)
    a, b, c = (chunk_map(counts, t) for t in ("one tw", "othre", "e four  "))
    assert compose(counts, compose(counts, a, b), c) == compose(counts, a, compose(counts, b, c))


def test_query_equals_the_library(spark):
    library = Tokenizer.from_file(PATH)
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {(r.doc_id, len(r.text.encode()), n := len(library.encode(r.text, add_special_tokens=False).ids), n > 2048) for r in rows}
    assert {tuple(r) for r in op6_token_counts(spark, SMALL).collect()} == want


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (3, "", 1), (3, "a b", 1), (3, "a b", 1), (4, "w " * 300_000, 2)], "doc_id long, text string, n_tokens int")
    got = sorted((tuple(r) for r in token_counts(docs).collect()), key=str)
    assert got == sorted([(None, 0, 0, False), (3, 0, 0, False), (3, 3, 2, False), (3, 3, 2, False), (4, 600_000, 300_000, True)], key=str)
    assert token_counts(docs.filter(F.lit(False))).count() == 0

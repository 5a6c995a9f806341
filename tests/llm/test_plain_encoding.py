"""Ids are those of the tokenizer file as the library loads it."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ocellus.llm import packing, token_orc
from ocellus.llm.tokens import Encoder


@pytest.mark.parametrize("vocab", [token_orc.VOCAB, packing.VOCAB])
def test_added_tokens_and_dotted_capital(vocab):
    plain = Tokenizer.from_file(public_tokenizers.path(vocab))
    texts = ["some words <|endoftext|> and more", "<|endoftext|>", "x<|startoftext|>y", "<|ENDOFTEXT|> a", "a <|endoftext| b",
             "aİ!", "İ, b", "ABİ.", "plain words, nothing more"]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert Encoder(vocab).encode(texts) == want


def test_an_id_of_very_many_rows_is_written_in_order(spark):
    """``start`` follows the files also where an id repeats, in several files."""
    rows = [(7, f"text {i % 50} " * (i % 9)) for i in range(600)] + [(i, "x y") for i in range(14)] + [(None, "n")] * 20
    df = spark.createDataFrame(rows, "doc_id long, text string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from ocellus.session import scratch_path
        path = scratch_path(spark, "orc-test")
        token_orc.write_token_orc(df, path)
        parts = {}
        for r in token_orc.read_token_orc(spark, path).collect():
            parts.setdefault(r["part"], []).append(r)
        found = sorted(token_orc.token_index(spark, path).collect(), key=lambda r: r["start"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    in_files = [r for p in sorted(parts) for r in sorted(parts[p], key=lambda r: r["seq"])]
    assert sum(any(r["doc_id"] == 7 for r in p) for p in parts.values()) > 2
    assert [(r["doc_id"], len(r["ids"])) for r in in_files] == [(r["doc_id"], r["n_tokens"]) for r in found]
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and found[0]["start"] == 0
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(found, found[1:]))

"""Op 9 against ``tokenizers`` at its defaults: strings of added tokens become these tokens; op 6 knows none."""

import zlib

import numpy as np

from riskloom.llm import byte_bpe, packing

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "a  <|endoftext|>\n\n b  c<|endoftext|", "it's <|ENDOFTEXT|>", "", "a " * 3000 + "<|endoftext|>" + " b" * 3000]


def test_added_tokens(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.VOCABULARY)
    want = {i: [*t.encode(x, add_special_tokens=False).ids, packing.END_ID] for i, x in enumerate(TEXTS)}
    assert want[0][:-1] == [64, 220, 50256, 275]
    rows = packing.digest(packing.pack(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"))).collect()
    for r in rows:
        own = want[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
    assert sum(r["length"] for r in rows) == sum(map(len, want.values()))


def test_op6_has_no_added_tokens(spark):
    out = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")).collect()}
    assert out[0] == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]

import random

import public_tokenizers
from sentencepiece import SentencePieceProcessor

from tidewatt.llm.tokens import PairMerger, op2_token_counts, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n", "  a b", "a  b ", "a\nb\tc", "<s> hello </s>", "ﬁ Å é", "　x", "a​b\x00c", "▁x", "▁▁ x▁", "\n\n a \n b", "日本語 テキスト", "x" * 3000, "🙂🙂 \n🙂", "\r\n\r\n", "\n "]


def test_counts_equal_the_library():
    model, merger = SentencePieceProcessor(model_file=PATH), PairMerger(PATH, cache=500)
    draw = random.Random(5)
    texts = ODD + ["".join(draw.choice(" \nab▁.é🙂\tthe") for _ in range(draw.randint(0, 60))) for _ in range(1500)]
    assert [merger.count(t) for t in texts] == [len(model.encode(t)) for t in texts]


def test_query_over_whole_table(spark, small, sample):
    model = SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op2_token_counts(spark, small).collect()}
    for doc_id, text in sample:
        tokens = len(model.encode(text or ""))
        assert got[doc_id] == (len((text or "").encode()), tokens, tokens > 4096)


def test_null_empty_repeated_and_empty_table(frame):
    got = token_counts(frame([(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b")]), PATH).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == [(0, 3, 2), (1, 0, 0), (2, 0, 0), (3, 3, 2), (3, 3, 2)]
    assert token_counts(frame([]), PATH).count() == 0

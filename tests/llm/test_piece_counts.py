import sentencepiece

from tallyweir.llm import piece_counts
from tallyweir.llm.catalog import tokenizer_path
from tests.llm.common import awkward, clashing, documents, empty, sentence

PATH = tokenizer_path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
TEXTS = [
    " a", "a ", "  a  b   ", " ", "   ", "\n", "a\n", "\na", " \n ", "a\n\n b", "▁a ▁ b▁▁", "a▁ b", "\t a\r\n b", "<s> </s> <unk>",
    "<0x0A>", "é漢字😀 \x00 x", "\x85 　y", "ﬁ ½ Å", "a" * 300, "😀" * 100, sentence(3, 5000),
]


def expected(docs):
    rows = []
    for r in docs.collect():
        text = r["text"] or ""
        n = len(MODEL.encode(text))
        rows.append((r["doc_id"], len(text.encode()), n, n > piece_counts.LIMIT))
    return sorted(rows, key=repr)


def test_counts_equal_the_library(spark):
    docs = documents(spark, TEXTS + [sentence(i, 11 * i) for i in range(20)]).unionByName(awkward(spark))
    assert any(row[3] for row in expected(docs))
    for common in (piece_counts.COMMON, 20, 1):
        made = piece_counts.token_counts(clashing(docs), PATH, common=common).collect()
        assert sorted(map(tuple, made), key=repr) == expected(docs)


def test_empty_table(spark):
    assert piece_counts.token_counts(empty(spark), PATH).count() == 0

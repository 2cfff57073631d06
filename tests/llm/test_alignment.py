import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabula.llm import alignment as A
from tabula.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    FIRST = file.read()
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
    SECOND = file.read()
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(rows):
    """The contract read plainly: whole texts, every pair of tokens that end together."""
    import sentencepiece

    first = Tokenizer.from_str(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_proto=SECOND)
    letters = A.byte_letters()
    docs = []
    for doc_id, text in rows:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else None
        b = second.encode(text) if text else None
        if text:
            bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
            pieces = [second.id_to_piece(i) for i in b]
            bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in zip(b, pieces)]
            raw = (" " + text).encode()
        if not text or b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            docs.append((doc_id, 0, 0, [], ""))
            continue
        links, groups, i, j, at_a, at_b, from_i, from_j = [], [], 0, 0, 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                at_a, i = at_a + len(bytes_a[i]), i + 1
            else:
                at_b, j = at_b + len(bytes_b[j]), j + 1
            if at_a == at_b:
                links.append((a[i - 1], b[j - 1]))
                groups.append(",".join(map(str, a[from_i:i])) + "|" + ",".join(map(str, b[from_j:j])))
                from_i, from_j = i, j
        docs.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(p for d in docs for p in d[3])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(((i, na, nb, len(links), len(links), sum(counts[p] == most[p[1]] for p in links),
                    sum(counts[p] for p in links), h) for i, na, nb, links, h in docs), key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=repr)


ODD = [(1, "<s> </s> <|endoftext|> <unk> <0x0A>"), (2, "a▁b"), (3, "▁"), (4, "tab\tnew\nline \r\n  end  "),
       (5, " leading"), (6, "emoji 😀 文字 ́ \x00 \xa0"), (7, "é" * 50), (8, " "), (9, "same text"), (9, "same text"),
       (None, "no id"), (None, None), (10, ""), (11, "don't WON'T 12345 !!!??? ..."), (12, "x" * 3000)]


def test_equals_brute_force_on_odd_texts(spark):
    docs = spark.createDataFrame(ODD, "doc_id bigint, text string").withColumns(
        {c: F.lit("clash") for c in ("row", "pair", "pairs", "times", "n", "best", "second", "n_a")})
    assert collected(A.link_statistics(docs, FIRST, SECOND)) == brute(ODD)


@pytest.mark.parametrize("common", [0, 40, 1 << 17])
def test_common_and_other_pairs_give_all_links(spark, edge_docs, edge_rows, common):
    got = collected(A.link_statistics(edge_docs, FIRST, SECOND, common=common))
    assert got == brute([r[:2] for r in edge_rows])


@pytest.mark.parametrize("stored", [0, 7, 1 << 16])
def test_segments_do_not_change_the_result(spark, edge_rows, stored):
    rng = random.Random(stored)
    pieces = [" ", "  ", "\n", " \n", "\t ", "word", "Zé", "'s", "12", "!?", "文", "\x1c", "\xa0", "▁"]
    rows = [(k, "".join(rng.choice(pieces) for _ in range(300))) for k in range(40)]
    rows += [r[:2] for r in edge_rows[:4]]
    sides = A.Sides(FIRST, SECOND)
    assert all("".join(sides.segments(t or "")) == " " + (t or "") for _, t in rows) and not sides.whole
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert collected(A.link_statistics(docs, FIRST, SECOND, stored=stored)) == brute(rows)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(rows)
    assert collected(QUERIES["op13_token_alignment"](spark, SF)) == want
    assert sum(r[4] for r in want) > 10_000


def test_border_of_common_pairs(spark):
    counts = spark.createDataFrame([(k, n) for k, n in enumerate([1, 1, 1, 2, 3, 4, 9, 100])], "pair bigint, n bigint")
    for common in range(9):
        border = A.common_border(counts, common)
        assert counts.where(F.col("n") >= border).count() <= common
    assert A.common_border(counts, 8) == 1 and A.common_border(counts, 4) == 4


def test_empty_table(spark, no_docs):
    assert A.link_statistics(no_docs, FIRST, SECOND).collect() == []

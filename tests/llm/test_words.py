"""Words that polynomials modulo 2**64 cannot tell apart."""

from yoyflow.llm import decontaminate, ngram_join, recompression


def thue_morse(n: int) -> tuple[str, str]:
    s = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return s, s.translate(str.maketrans("ab", "ba"))


def test_regular_long_words_have_their_own_names():
    for n in (1024, 2048, 4096):
        one, other = thue_morse(n)
        names, count = recompression.word_names([one.encode(), other.encode()])
        assert names[0] != names[1] and count.tolist() == [1, 1]
        h = decontaminate.word_hashes(decontaminate.split_words([one.encode(), other.encode()]), 0x100000001B3)
        assert h[0] != h[1]
        a, b = ngram_join.ngram_sets([one.encode(), other.encode()])
        assert a[0] != b[0]


def test_a_repeat_with_another_long_word_is_none(spark):
    one, other = thue_morse(1024)
    words = [f"w{i}" for i in range(49)]
    rows = [(1, " ".join([*words[:25], one, *words[25:]])), (2, " ".join([*words[:25], other, *words[25:]])), (3, " ".join([*words[:25], one, *words[25:]]))]
    got = {r["doc_id"]: r["n_removed"] for r in recompression.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 0, 3: 50}

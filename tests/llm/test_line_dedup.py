"""Aligned common blocks go from the later document only."""

import random

import pytest

from sievelog.llm.line_dedup import aligned_blocks, common_runs, drop_repeated_blocks, line_blocks, line_dedup, longest_increasing


def test_longest_increasing_against_brute_force():
    draw = random.Random(1)
    for _ in range(200):
        ys = draw.sample(range(9), draw.randrange(8))
        pairs = list(enumerate(ys))
        best = max((bin(m).count("1") for m in range(1 << len(ys)) if (p := [y for i, y in pairs if m >> i & 1]) == sorted(p)), default=0)
        got = longest_increasing(pairs)
        assert len(got) == best and got == sorted(got) and [y for _, y in got] == sorted(y for _, y in got)


def test_blocks_grow_over_repeated_neighbours():
    late, early = [9, 8, 7, 1, 2, 2, 5], [3, 1, 2, 2, 6, 5]
    words = [3, 3, 3, 10, 8, 8, 3]
    assert aligned_blocks(late, early, words, 20) == [(3, 6)]
    assert aligned_blocks(late, early, words, 27) == []


def test_blocks_in_another_order():
    late, early = [1, 2, 50, 3, 4], [3, 4, 60, 1, 2]
    assert sorted(aligned_blocks(late, early, [10] * 5, 20)) == [(0, 2), (3, 5)]


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_passages_and_clean_documents(spark):
    draw = random.Random(5)
    passage = [words(draw, 30) for _ in range(3)]
    rows = []
    for i in range(40):
        own = [words(draw, 12) for _ in range(4)]
        lines = own[:2] + passage + own[2:] if i % 2 else own
        rows.append((i, "\n".join(lines), "\n".join(own), "x"))
    rows += [(100, None, None, None), (101, "", "", None), (102, "\n\n", "\n\n", None), (None, rows[0][1], "", None), (103, rows[2][1], "", "x"), (103, rows[2][1], "", "x"), (104, "w " * 30000, "w " * 30000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, want string, line string")
    out = {(r.doc_id, r.want): r for r in line_dedup(df).collect()}
    for i, text, want, _ in rows:
        r = out[i, want]
        assert r.text == (text if i == 1 else want), i
    assert out[3, rows[3][2]].n_removed == 3 and out[100, None].n_lines == 0


def test_short_repeats_stay(spark):
    df = spark.createDataFrame([(1, "Released under a license.\nalpha"), (2, "Released under a license.\nbeta")], "doc_id long, text string")
    assert [r.n_removed for r in line_dedup(df).collect()] == [0, 0]


def test_emptied_documents_go(spark):
    long = " ".join(map(str, range(30)))
    df = spark.createDataFrame([(1, long, "en", "s", 1), (2, long, "en", "s", 1), (3, " ", "en", "s", 1), (4, long + "\nmore", "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: (r.text, r.n_chars) for r in drop_repeated_blocks(df).collect()}
    assert out == {1: (long, 1), 3: (" ", 1), 4: ("more", 4)}


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_block_shared_through_other_first_holders(spark):
    """Each line of the passage stands alone in another document before the two that share the passage."""
    draw = random.Random(8)
    passage = [words(draw, 10) for _ in range(6)]
    rows = [(i, "\n".join([words(draw, 12), passage[i % 6], words(draw, 12)])) for i in range(6)]
    rows += [(i, "\n".join([words(draw, 12), *passage, words(draw, 12)])) for i in (6, 9)]
    out = {r.doc_id: r.n_removed for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {i: 6 if i == 9 else 0 for i in (*range(7), 9)}


def brute_kept(rows, min_words=20):
    """Texts without the longest runs of equal lines that any earlier document holds, over all pairs of lines."""
    out = {}
    for n, (doc, text) in enumerate(rows):
        lines, gone = text.split("\n"), set()
        for _, other in rows[:n]:
            theirs = other.split("\n")
            for i in range(len(lines)):
                for j in range(len(theirs)):
                    k = 0
                    while i + k < len(lines) and j + k < len(theirs) and lines[i + k] == theirs[j + k] != "":
                        k += 1
                    if sum(len(x.split()) for x in lines[i : i + k]) >= min_words:
                        gone |= set(range(i, i + k))
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def test_against_all_pairs(spark):
    draw = random.Random(9)
    stock = [words(draw, n) for n in (3, 5, 8, 8, 10, 10, 15, 25)]
    rows = []
    for i in range(80):
        lines = [words(draw, 4) for _ in range(3)] + draw.sample(stock, 3)
        draw.shuffle(lines)
        at = draw.randrange(5)
        rows.append((i, "\n".join(lines[:3] + stock[at : at + draw.randrange(4)] + lines[3:])))
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_kept(rows)
    assert sum(got[i] != text for i, text in rows) > 40


@pytest.mark.parametrize("kinds", [2, 3, 5, 20])
def test_documents_of_few_different_lines(spark, kinds):
    """Lines that repeat many times in a document: exactly the blocks that all pairs of lines give."""
    draw = random.Random(kinds)
    stock = [words(draw, n) for n in draw.choices((3, 6, 7, 7, 8, 11), k=kinds)]
    rows = [(i, "\n".join(draw.choices(stock, k=draw.randrange(2, 14)) + [words(draw, 5)] * (i % 2) + draw.choices(stock, k=draw.randrange(9)))) for i in range(40)]
    got = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_kept(rows)


def test_runs_of_a_pair():
    draw = random.Random(2)
    for _ in range(3000):
        late, early = ([draw.randrange(3) for _ in range(draw.randrange(12))] for _ in range(2))
        weights = [draw.choice((7, 8, 20)) for _ in late]
        want = {k for i in range(len(late)) for j in range(len(early)) for n in range(1, len(late) - i + 1) if late[i : i + n] == early[j : j + n] and sum(weights[i : i + n]) >= 20 for k in range(i, i + n)}
        got = {k for a, b in aligned_blocks(late, early, weights, 20) for k in range(a, b)}
        assert got == want
        assert all(late[a:b] == early[at : at + b - a] for a, at, b in common_runs(late, early))
    assert aligned_blocks([4, 2, 2, 2], [2, 2, 0, 2, 2, 2], [8, 7, 7, 7], 20) == [(1, 4)]


def test_a_common_line_inside_a_passage(spark):
    draw = random.Random(12)
    passage = [words(draw, 9) for _ in range(3)]
    rows = [(0, passage[1])] + [(i, "\n".join([words(draw, 12), *passage, words(draw, 12)])) for i in (5, 7)]
    out = {r.doc_id: r.n_removed for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {0: 0, 5: 0, 7: 3}


@pytest.mark.parametrize("rare", [1, 2, 5, 100])
def test_rare_lines_and_runs_find_the_same(spark, rare):
    draw = random.Random(14)
    stock = [words(draw, n) for n in (3, 5, 8, 8, 10, 10, 15, 25)]
    rows = [(i, "\n".join(words(draw, 4) if draw.random() < 0.3 else stock[draw.randrange(8)] for _ in range(draw.randrange(14)))) for i in range(60)]
    rows += [(None, rows[3][1]), (70, rows[3][1]), (70, rows[3][1]), (70, rows[9][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    blocks = line_blocks(df, rare=rare)
    got = {(r.doc, tuple(tuple(b) for b in r.blocks)) for r in blocks.collect()}
    want = {(r.doc, tuple(tuple(b) for b in r.blocks)) for r in line_blocks(df, rare=3).collect()}
    lines = lambda x: {(d, i) for d, blocks in x for a, b in blocks for i in range(a, b)}
    assert lines(got) == lines(want) and got


def test_blank_lines_and_earlier_repeats_do_not_cut_a_block(spark):
    draw = random.Random(10)
    short, long = [words(draw, 10) for _ in range(6)], [words(draw, 30) for _ in range(3)]
    rows = [(0, "\n\n".join(short)), (1, "\n".join(long)), (2, words(draw, 12) + "\n" + "\n\n".join(short)), (3, "\n \n".join(short) + "\n\n" + words(draw, 5))]
    rows += [(4, short[2] + "\n" + words(draw, 12) + "\n" + "\n".join(short)), (5, "\n\n".join(long)), (6, long[0] + "\n\n" + long[2])]
    out = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].n_removed for i in range(7)] == [0, 0, 11, 11, 6, 5, 2]
    assert out[2].text == rows[2][1].split("\n")[0] and out[4].text == "\n".join(rows[4][1].split("\n")[:2]) and out[6].text == ""

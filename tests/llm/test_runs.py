"""Deleted blocks against a loop over all pairs of documents."""

from __future__ import annotations

import random

from tallywork.llm import patience_dedup


def cleaned(spark, texts: list[str]) -> list[str]:
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [row["text"] for row in patience_dedup.without_repeats(documents).orderBy("doc_id").collect()]


def slow(texts: list[list[str]]) -> list[list[str]]:
    """Blocks of eight words or more that patience diff aligns with any earlier document, among all or among long lines."""
    out = []
    for i, text in enumerate(texts):
        gone: set[int] = set()
        for other in texts[:i]:
            for least in (1, 5):
                mine, its = ([n for n, line in enumerate(x) if len(line.split()) >= least] for x in (text, other))
                pairs, block = patience_dedup.patience([text[n] for n in mine], [other[n] for n in its]), []
                for pair in [*pairs, None]:
                    if block and (pair is None or pair != (block[-1][0] + 1, block[-1][1] + 1)):
                        if sum(len(text[mine[x]].split()) for x, _ in block) >= 8:
                            gone.update(mine[x] for x, _ in block)
                        block = []
                    block += [pair] if pair else []
        out.append([line for n, line in enumerate(text) if n not in gone])
    return out


def test_blocks_are_those_of_all_pairs(spark):
    dice = random.Random(4)
    lines = [f"l{n}" + f" of{n}" * dice.randrange(10) for n in range(120)]
    texts = []
    for i in range(60):
        text = []
        for _ in range(dice.randrange(1, 6)):
            at = dice.randrange(120)
            text += range(at, min(120, at + dice.randrange(1, 9)))
        texts.append([own for n in sorted(set(text)) for own in ([lines[n]] + [f"own line {i} {n}"] * (dice.random() < 0.2))])
    assert cleaned(spark, ["\n".join(text) for text in texts]) == ["\n".join(text) for text in slow(texts)]


def test_a_block_does_not_break_at_a_line_first_held_elsewhere(spark):
    block = ["Released under the Link License", "a line of six words here", "Of.", "five words are in it"]
    texts = ["\n".join(["x " * 9, block[1], "y " * 9]), "\n".join(block), "\n".join(["own beginning", *block, "own end"])]
    assert cleaned(spark, texts)[2] == "own beginning\nown end"


def test_short_lines_and_scripts_without_blanks(spark):
    verse = "Tyger Tyger,\nburning bright,\nIn the forests\nof the night;\n\nWhat immortal\nhand or eye"
    han = "这是一个很长的句子没有任何空格但是它有很多的字符在里面"
    assert cleaned(spark, [verse, "A poem\n" + verse + "\nof mine", han, "标题\n" + han + "\n结束"])[1::2] == ["A poem\nof mine", "标题\n结束"]

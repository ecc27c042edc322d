"""Operators that look at rows one by one or at lines: quality rules, line dedup, decontamination."""

import collections
import pathlib
import random
import sys

import numpy as np
import pytest
import regex

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from helpers import WORD, awkward, awkward_texts, edited, prose, rows  # noqa: E402

from cropspark.llm import decontamination, line_dedup, quality_rules  # noqa: E402
from cropspark.llm import queries as registered  # noqa: E402


def test_measures_match_brute_force(spark):
    found = {r["doc_id"]: r for r in quality_rules.judge(awkward(spark)).collect()}
    assert len(found) == len(awkward_texts())
    for i, text in enumerate(awkward_texts()):
        text = text or ""
        words = WORD.findall(text)
        windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
        counted = collections.Counter(windows)
        twice = {k + j for k, w in enumerate(windows) if counted[w] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        own = found[i]
        assert own["n_words"] == len(words)
        assert own["word_chars"] == sum(map(len, words))
        assert own["n_dup_lines"] == len(lines) - len(set(lines))
        assert own["n_repeat_words"] == len(twice)
        assert own["n_letter_words"] == sum(regex.search(r"\p{L}", w) is not None for w in words)
        blanks = " \t\n\x0b\x0c\r"
        assert own["n_ellipsis_lines"] == sum(x.strip(blanks).endswith(("...", "…")) for x in lines)
        assert own["n_bullet_lines"] == sum(x.strip(blanks)[0] in quality_rules.BULLETS for x in lines)
        assert own["base_failed"] == (len(words) < 10 or 100 * len(twice) > 20 * len(words))
        assert not (own["kept"] and own["base_failed"])


def test_rules_are_read_from_the_table(spark):
    docs = awkward(spark, ["### $$$ " * 10 + prose(1, 30), prose(1, 60)])
    rule = quality_rules.Rule("symbols", "symbols_per_word", None, 0.1)
    judged = {r["doc_id"]: r["broken_rules"] for r in quality_rules.judge(docs, (rule,)).collect()}
    assert judged == {0: ["symbols"], 1: []}
    kept = quality_rules.keep_good(docs, (rule,))
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert rows(quality_rules.judge(docs, ()), "broken_rules") == [([],), ([],)]


def test_menus_break_the_symbol_rule(spark):
    menu = " | ".join(["home", "the news", "of", "contact"] + [f"entry{i}" for i in range(20)])
    judged = {r["doc_id"]: (r["broken_rules"], r["kept"]) for r in quality_rules.judge(awkward(spark, [menu, prose(1, 60) + " the of"])).collect()}
    assert judged == {0: (["symbol_ratio"], False), 1: ([], True)}


def test_lines_and_letters_break_their_rules(spark):
    lead = "the of and to in a is that it for "
    texts = {
        "ellipsis_lines": "\n".join(f"{lead}read more about part {i} ... " for i in range(8)),
        "bullet_lines": "\n".join(f" - {lead} entry number {i} of the list" for i in range(8)),
        "letter_words": lead + " ".join(f"{i}.{i}" for i in range(40)),
        "stop_words": "the " + " ".join(f"wörter{i}" for i in range(60)),
        "length": " ".join(f"{lead}{i} is" for i in range(9000)),
    }
    judged = quality_rules.judge(awkward(spark, list(texts.values()))).collect()
    assert {list(texts)[r["doc_id"]]: r["broken_rules"] for r in judged} == {name: [name] for name in texts}


def test_limits_against_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    if not pathlib.Path(folder).exists():
        pytest.skip("no test tables")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [r for r in quality_rules.judge(spark.read.parquet(f"{folder}/documents.parquet")).collect() if r["n_words"] >= 10]
    good = [r for r in judged if labels.get(r["doc_id"]) == 1]
    bad = [r for r in judged if labels.get(r["doc_id"]) == 0]
    symbols = [r for r in bad if r["n_symbols"] > 0]
    assert good and symbols and all("symbol_ratio" in r["broken_rules"] for r in symbols)
    for rule in quality_rules.RULES:
        assert sum(rule.name in r["broken_rules"] for r in good) <= len(good) // 100, rule.name


def test_quality_plan_has_no_python(spark):
    plan = quality_rules.judge(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def spans_of(lines):
    """Chunks by the definition, as (first, last): to the next end, and from the last beginning."""
    import hashlib

    values = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    rolled = [(a * 31 + b) % line_dedup.MODULUS for a, b in zip(values, values[1:])]
    z = len(lines) - 1
    ends = [i for i in range(1, z + 1) if i == z or rolled[i - 1] % line_dedup.DIVISOR]
    begins = [i for i in range(z) if i == 0 or rolled[i] // line_dedup.DIVISOR % line_dedup.DIVISOR]
    most = line_dedup.MOST_LINES - 1
    out = {(i, min(next(e for e in ends if e > i), i + most)) for i in range(z)}
    return sorted(out | {(max([b for b in begins if b < j][-1], j - most), j) for j in range(1, z + 1)})


def without_repeats(texts):
    """What is left of each text, in order of place: later chunks are cut out, None stays."""
    first, out = {}, []
    for i, text in enumerate(texts):
        for a, b in spans_of(text.split("\n")) if text is not None else []:
            key = tuple(text.split("\n")[a : b + 1])
            first[key] = min(first.get(key, (i, a)), (i, a))
    for i, text in enumerate(texts):
        lines = [] if text is None else text.split("\n")
        gone = {k for a, b in spans_of(lines) if first[tuple(lines[a : b + 1])] != (i, a) for k in range(a, b + 1)}
        kept = [x for k, x in enumerate(lines) if k not in gone]
        out.append((None if text is None else "\n".join(kept), len(gone), len(lines)))
    return out


def test_line_dedup_matches_brute_force(spark):
    texts = awkward_texts()
    found = line_dedup.dedup_lines(awkward(spark)).select("doc.doc_id", "text_left", "n_removed_lines", "n_lines")
    assert sorted(tuple(r) for r in found.collect()) == [(i, *x) for i, x in enumerate(without_repeats(texts))]


def repeated_runs(texts):
    """Every later run of two or more lines that also stand in a row before: (text, first, last)."""
    seen, out = set(), []
    for i, text in enumerate(texts):
        lines = text.split("\n")
        pairs = [(a, b) in seen for a, b in zip(lines, lines[1:])]
        k = 0
        while k < len(pairs):
            end = k
            while end < len(pairs) and pairs[end]:
                end += 1
            if end > k:
                out.append((i, k, end))
            k = end + 1
        seen.update(zip(lines, lines[1:]))
    return out


def test_recall_of_repeated_runs():
    """Passages of 2 to 7 lines put between other lines: nine in ten go whole, and copies of texts always."""
    rng = random.Random(6)
    passages = [[f"passage {i} line {k} {rng.random()}" for k in range(2 + i % 6)] for i in range(120)]
    texts = []
    for i in range(600):
        own = [f"text {i} line {k} {rng.random()}" for k in range(rng.randrange(1, 8))]
        at = rng.randrange(len(own) + 1)
        texts.append("\n".join(own[:at] + passages[rng.randrange(120)] + own[at:]))
    texts += [texts[i] for i in range(0, 600, 7)]
    left = without_repeats(texts)
    runs = repeated_runs(texts)
    whole = sum(not set(texts[i].split("\n")[a : b + 1]) & set(left[i][0].split("\n")) for i, a, b in runs)
    assert len(runs) > 400 and whole >= 0.9 * len(runs)
    assert all(text == "" for text, _, _ in left[600:])
    lost = sum(n for _, n, _ in left) - sum(b - a + 1 for _, a, b in runs)
    assert lost <= 0  # nothing goes but repeated runs


def test_line_dedup_of_long_texts_of_one_line_again_and_again(spark):
    """Forty thousand lines, all alike, alternating, and all different; two copies of each."""
    texts = ["same\n" * 40_000, "a\nb\n" * 20_000, "\n".join(f"line {i}" for i in range(40_000))]
    docs = awkward(spark, [t for t in texts for _ in range(2)])
    left = {r["doc_id"]: r["text_left"] for r in line_dedup.dedup_lines(docs).select("doc.doc_id", "text_left").collect()}
    assert left[4] == texts[2] and left[5] == "" and all(len(left[i]) < 200 for i in (0, 1, 2, 3))


def test_line_dedup_keeps_columns_and_rows_without_id(spark):
    text = "first line\nsecond line\nthird line\nfourth line\nfifth line\nsixth line"
    docs = spark.createDataFrame([(None, text, "a"), (1, text, "b"), (2, text, "c")], "doc_id bigint, text string, gone string")
    out = line_dedup.without_repeats(docs, length_col=None)
    left = {(r["doc_id"], r["gone"]): r["text"] for r in out.collect()}
    assert out.columns == docs.columns
    assert left[None, "a"] == text and left[1, "b"] == text
    assert (2, "c") not in left or len(left[2, "c"]) < len(text)


def test_chunks_are_shift_resistant():
    shared = [f"shared line {i}" for i in range(40)]
    a, b = ["one"] + shared, ["x", "y", "z"] + shared + ["end"]
    texts = [{tuple(lines[x : y + 1]) for x, y in spans_of(lines)} for lines in (a, b)]
    common = {line for chunk in texts[0] & texts[1] for line in chunk}
    assert len(common) >= 39


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_items_are_found_with_edits_and_case(spark):
    items = [prose(100 + i, 30, lines=False) for i in range(6)]
    few = list(items[3])
    few[20], few[77], few[150:150] = "q", "q", "zz"
    texts = [
        prose(1, 50) + " " + items[0] + " " + prose(2, 50),
        prose(3, 50) + "\n" + items[1].upper().replace(" ", ", ") + "." + prose(4, 20),
        prose(5, 50) + " " + items[2][: len(items[2]) // 2] + " " + prose(6, 50),
        "".join(few),
        edited(items[4], 1, 0.5),
        None,
        "",
        items[5],
        items[5],
    ]
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "ab"), (92, "")], "item_id bigint, text string")
    found = rows(decontamination.matches(awkward(spark, texts), bench), "doc_id", "item_id", "edits")
    assert [x[:2] for x in found] == [(0, 0), (1, 1), (3, 3), (7, 5), (8, 5)]
    assert found[0][2] == 0 and found[1][2] == 0 and found[2][2] == edits("".join(few), items[3])
    places = {r["doc_id"]: (r["start"], r["end"]) for r in decontamination.matches(awkward(spark, texts), bench).collect()}
    a, b = places[0]
    assert texts[0].encode()[a:b].decode() == items[0]
    left = decontamination.without_leaks(awkward(spark, texts), bench)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 4, 5, 6]


def semi_global(item, text):
    """Fewest edits of the item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        row, old = [i], row
        for j, y in enumerate(text, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return min(row)


def plainly(text):
    shown = "".join(c.lower() if c.isascii() and c.isalnum() else c if not c.isascii() else " " for c in text)
    return regex.sub(" +", " ", shown).encode()


def test_items_are_those_of_all_alignments(spark):
    """All texts against all items, on both sides of the budget."""
    items = [prose(500 + i, 12 + 3 * i, lines=False)[: 60 + 21 * i] for i in range(8)] + ["short one", "tiny"]
    texts = []
    for i in range(40):
        rate = (i % 7) * 0.025
        copy = list(items[i % len(items)])
        rng = random.Random(i)
        for _ in range(int(rate * len(copy))):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(2)] = rng.choice(["", "z", "qq"])
        texts.append(f"{prose(600 + i, 15)} {''.join(copy)}, {prose(700 + i, 10)}")
    docs = awkward(spark, texts)
    found = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.matches(docs, spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")).collect()}
    expected = {}
    for j, item in enumerate(items):
        own = plainly(item).rstrip(b" ")
        budget = min(int(len(own) * decontamination.EDIT_RATE), (len(own) - decontamination.Q) // decontamination.Q) if len(own) >= decontamination.Q else -1
        for i, text in enumerate(texts):
            edits = semi_global(own, plainly(text))
            if edits <= budget:
                expected[i, j] = edits
    assert found == expected and len(expected) > 15


def test_banded_cells_give_what_all_cells_give():
    rng = random.Random(8)
    for _ in range(300):
        item = [rng.randrange(3) for _ in range(rng.randrange(1, 30))]
        region = [rng.randrange(3) for _ in range(rng.randrange(0, 8))] + item[: rng.randrange(30)] + [rng.randrange(3) for _ in range(rng.randrange(0, 12))]
        most = rng.randrange(0, 8)
        got = decontamination.placed(np.array(item, np.uint8), np.array(region, np.uint8), most)
        expected = semi_global(item, region)
        assert got[0] == min(expected, most + 1)
        if expected <= most:
            assert min(edits(item, region[a : got[1]]) for a in range(got[1] + 1)) == expected


def test_parts_of_long_items_are_found(spark):
    item = prose(800, 200, lines=False)
    huge = prose(801, 150_000, lines=False)
    third = len(item) // 3
    texts = [
        f"{prose(1, 50)} {item[: 2 * third]} {prose(2, 50)}", f"{prose(3, 40)} {item[third:]}", f"{prose(4, 60)} {item[:100]} {prose(5, 60)}",
        f"{prose(6, 30)} {huge[400_000:401_000]} {prose(7, 30)}", prose(8, 400), item, huge,
    ]
    bench = spark.createDataFrame([(0, item), (1, huge)], "item_id bigint, text string")
    found = decontamination.matches(awkward(spark, texts), bench).collect()
    assert len(huge) > 900_000 and sorted((r["doc_id"], r["item_id"]) for r in found) == [(0, 0), (1, 0), (3, 1), (5, 0), (6, 1)]
    places = {r["doc_id"]: (r["start"], r["end"]) for r in found}
    assert places[5] == (0, len(item)) and all(r["edits"] == 0 for r in found)


def test_rows_are_judged_by_their_text_not_their_id(spark):
    item = prose(900, 30, lines=False)
    docs = spark.createDataFrame([(None, item, 1), (1, "clean " + prose(901, 30), 2), (1, item, 3), (None, None, 4)], "doc_id bigint, text string, `a.b` int")
    bench = spark.createDataFrame([(5, item)], "item_id bigint, text string")
    left = decontamination.without_leaks(docs, bench)
    assert left.columns == docs.columns and sorted(r["a.b"] for r in left.collect()) == [2, 4]
    assert decontamination.without_leaks(docs.filter("false"), bench).count() == 0


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    items = [prose(200 + i, 25, lines=False) for i in range(12)]
    docs = awkward(spark, [prose(i, 20) + " " + t for i, t in enumerate(items)])
    bench = spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")
    whole = rows(decontamination.matches(docs, bench), "doc_id", "item_id", "start", "end")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    assert rows(decontamination.matches(docs, bench), "doc_id", "item_id", "start", "end") == whole
    assert len(whole) == 12


@pytest.mark.parametrize("name", ["op2_quality_rules", "op6_line_dedup"])
def test_empty_tables(spark, tmp_path, name):
    awkward(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert registered.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_decontamination_of_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.matches(awkward(spark), bench).count() == 0
    assert decontamination.without_leaks(awkward(spark), bench).count() == len(awkward_texts())

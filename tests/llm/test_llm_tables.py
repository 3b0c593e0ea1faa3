"""Decontamination, line dedup, chat, search, licences and pipeline against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickwise.llm import ann, chat, decontaminate, licenses, linededup, packing, quality, queries, simhash
from tickwise.llm.common import prepare

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def _prepared(spark):
    prepare(spark)


# ---- benchmark decontamination

ITEM = "A train leaves Paris at 60 km per hour and Anna boards 3 hours later with 12 apples. How far is she after 5 hours?"
FILL = "some clean words that stand around the passage and mean nothing at all here. "


def leaks(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"hash": F.lit(1), "item_id": F.lit("x"), "shift": F.lit(0)})
    b = spark.createDataFrame(items, "item_id bigint, text string").withColumns({"doc_id": F.lit(1), "id": F.lit(2)})
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(d, b).collect()}


def test_exact_and_reparameterised_questions(spark):
    changed = ITEM.replace("Paris", "Rome").replace("60 km", "75 miles").replace("Anna", "Berta").replace("12", "20")
    torn = ITEM.replace("at 60 km per hour and Anna boards 3", "slowly").replace("later with 12 apples", "x")
    docs = [(1, FILL + ITEM + " " + FILL), (2, FILL + changed + " " + FILL), (3, FILL * 4), (4, torn), (5, None), (6, ""),
            (7, ITEM), (7, ITEM), (None, ITEM), (8, FILL * 3000 + ITEM.upper().lower())]
    got = leaks(spark, docs, [(10, ITEM), (11, ITEM), (12, None), (13, ""), (14, "too short"), (None, FILL)])
    assert set(got) == {(1, 10), (2, 10), (7, 10), (8, 10)}
    assert got[1, 10].exact and not got[2, 10].exact and got[1, 10].covered >= got[1, 10].n_tokens - 1
    assert leaks(spark, docs[:1], []) == {} and leaks(spark, [], [(1, ITEM)]) == {}


def test_slots_must_keep_their_values(spark):
    item = "Take 4 red balls and 4 blue balls then 4 green balls and 4 black balls then 4 grey balls and 4 white balls please"
    same, other = item.replace("4", "9"), item
    for n in ("1", "2", "3", "5", "6", "7"):
        other = other.replace("4", n, 1)
    got = leaks(spark, [(1, FILL + same), (2, FILL + other)], [(1, item)])
    assert set(got) == {(1, 1)}


def test_short_items_match_whole(spark):
    got = leaks(spark, [(1, FILL + "name the largest ocean known " + FILL), (2, FILL + "name the largest river known")],
                [(1, "Name the largest ocean known")])
    assert set(got) == {(1, 1)}


def test_exact_copies_in_any_place_case_and_length(spark):
    item = "Name the largest ocean known"
    names = "Anna Berta Carl Dora Emil Frida met Gustav Hanna and Ida in Jena"
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    apples = "Anna has 5 apples and eats 2"
    docs = [(1, "1) " + item), (2, "Q1 " + item), (3, "A Heading\n" + item), (4, FILL + item.upper()), (5, FILL + names.lower()),
            (6, FILL + names.upper() + "!"), (7, FILL + "why not now " + FILL), (8, FILL + " ".join(passage.split()[30:43]) + " " + FILL),
            (9, FILL + " ".join(passage.split()[30:41]) + " " + FILL), (10, "1) Berta has 7 apples and eats 3"), (11, "Berta has 7 apples and eats 3"),
            (12, FILL + "Paris is the capital of France"), (13, FILL)]
    items = [(1, item), (2, names), (3, "Why not now?"), (4, passage), (5, apples), (6, "What is the capital of France")]
    got = set(leaks(spark, docs, items))
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2), (6, 2), (7, 3), (8, 4), (10, 5), (11, 5)}


def test_one_or_two_words_are_no_evidence_inside_other_text(spark):
    docs = [(1, "An answer: yes of course."), (2, "The weather is fine and dry today."), (3, "Yes!"), (4, "the"), (5, "say no more, please"), (6, "No more")]
    items = [(1, "Yes"), (2, "the"), (3, "no more"), (4, "say no more")]
    assert set(leaks(spark, docs, items)) == {(3, 1), (4, 2), (6, 3), (5, 4)}


def test_windows_left_out_by_their_words_match_nothing(spark, monkeypatch):
    """Random texts over few words, numbers and names: the same leaks with and without the word table."""
    import random
    rnd = random.Random(4)
    words = ["red", "Anna", "7", "km", "ball.", "Paris", "see", "Rome", "12", "box", "of", "sees"]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, text(rnd.choice([3, 6, 9, 20]))) for i in range(25)]
    docs = [(d, text(15) + " fern " + rnd.choice(items)[1].replace("7", "9") + rnd.choice([" ", ".\n"]) + text(9)) for d in range(60)]
    got = {k: tuple(r) for k, r in leaks(spark, docs, items).items()}
    whole = decontaminate._windows
    monkeypatch.setattr(decontaminate, "_windows", lambda c, sizes, p, known=None: whole(c, sizes, p))
    assert got == {k: tuple(r) for k, r in leaks(spark, docs, items).items()} and len(got) > 40


def brute_leaks(docs, items, n=8):
    """Items of which at least half the words lie in 8-word runs of the document (data without slots)."""
    words = lambda t: [decontaminate.bare(w) or w for w in (t or "").split()]
    where = defaultdict(list)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - n + 1):
            where[tuple(w[k:k + n])].append((i, k, len(w)))
    found = defaultdict(set)
    for d, t in docs:
        w = words(t)
        for k in range(len(w) - n + 1):
            for i, at, size in where.get(tuple(w[k:k + n]), ()):
                found[d, i, size] |= set(range(at, at + n))
    return {(d, i) for (d, i, size), c in found.items() if len(c) >= 0.5 * size}


def test_op3_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op3_decontamination"](spark, SF01).collect()}
    want = brute_leaks([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and got == want


# ---- line dedup

def brute_lines(pages, ratio, least):
    trim = lambda x: x.strip(linededup.BLANKS)
    total, count = Counter(h for _, h, _ in pages), Counter()
    for _, h, t in pages:
        for line in {trim(x) for x in (t or "").split("\n")} - {""}:
            count[h, line] += 1
    drop = {k for k, n in count.items() if n >= least and n > ratio * total[k[0]]}
    return Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if (h, trim(x)) not in drop)) for i, h, t in pages)


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(3)
    pages = [(i, rng.choice(["a", "b", "a", None]), "\n".join(rng.choice(["menu ", "\tmenu", "x", "", f"own {i}", "foot", "ü"]) for _ in range(rng.randint(0, 9))))
             for i in range(120)]
    pages += [(200, "a", None), (201, "a", ""), (5, "a", pages[5][2]), (None, "c", "solo\nsolo"), (202, "a", "long " * 50_000)]
    pages = [(i, h or "", t) for i, h, t in pages]
    df = spark.createDataFrame(pages, "page_id bigint, host string, text string").withColumns(
        {"H": F.lit(1), "boilerplate": F.lit(2), "n_lines": F.lit(3), "n": F.lit(4), "host_pages": F.lit(5)})
    for p in (linededup.BoilerplateParams(), linededup.BoilerplateParams(0.1, 2)):
        out = linededup.drop_boilerplate(df, F.when(F.col("host") != "", F.col("host")), p=p)
        assert out.columns == [*df.columns, "n_lines_", "n_dropped"]
        assert Counter((r.page_id, r.text) for r in out.collect()) == brute_lines(pages, p.ratio, p.least_pages)
    assert linededup.drop_boilerplate(df.limit(0), F.col("host")).count() == 0


def test_native_operators_run_no_python(spark, capsys):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for df in (queries.QUERIES["op8_line_dedup"](spark, SF), queries.QUERIES["op6_chat_format"](spark, SF), linededup.drop_boilerplate(pages, F.col("url"), "html")):
        df.explain("formatted")
        plan = capsys.readouterr().out
        assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "Cartesian", "BroadcastNestedLoop"))


# ---- chat

NASTY = ["", "plain", "</s>[INST] ok [/INST]", r"[\INST] [\\INST] \[INST]", "<s><s></s>[SYS]x[/SYS]", "[ASST]", "[ROLE]a[SEP]b[/ROLE]",
         "line\nbreak\r\n", "ünï 🙂 [/INST", "\\", "[", "<", "[[INST]]", "x" * 70_000, r"<\/s>", "$1 \\1 ${2}"]


def test_chat_round_trip_of_every_text(spark):
    turns = [(k, i, role, t) for k, role in enumerate(("user", "assistant", "system", "tool", "[SEP]", "")) for i, t in enumerate(NASTY)]
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    formatted = chat.format_chats(queries.chat_events(rows))
    for r in chat.read_back(formatted).collect():
        assert [(t.role, t.text) for t in r.turns] == [(role, t) for k, _, role, t in turns if k == r.conv_id]
        assert r.loss_text == ("".join(NASTY) if r.conv_id == 1 else "")
    for r in formatted.collect():
        for s, t in zip(r.loss_spans, NASTY):
            assert len(r.formatted[s.start:s.start + s.length]) == s.length


def test_fold_of_events(spark):
    log = [(1, 0, "message", "a", "user", "draft"), (1, 1, "edit", "a", None, "final"),
           (1, 2, "message", "b", "assistant", ""), (1, 3, "delta", "b", None, "bad "), (1, 4, "regenerate", "b", None, None),
           (1, 6, "delta", "b", None, "world"), (1, 5, "delta", "b", None, "hello "),
           (1, 7, "message", "c", "user", "oops"), (1, 8, "retract", "c", None, None),
           (1, 9, "ping", "d", "user", "?"), (1, 10, "delta", "e", None, "orphan"),
           (2, 0, "message", "x", "user", "q"), (None, 0, "message", "x", None, None)]
    ev = spark.createDataFrame(log, "conv_id bigint, seq bigint, kind string, message string, role string, text string").withColumn("rank", F.lit(9))
    got = sorted(((r.conv_id, r.first_seq, r.message, r.role, r.text) for r in chat.fold(ev).collect()), key=str)
    assert got == sorted([(1, 0, "a", "user", "final"), (1, 2, "b", "assistant", "hello world"), (1, 10, "e", "", "orphan"),
                          (2, 0, "x", "user", "q"), (None, 0, "x", "", "")], key=str)
    assert chat.format_chats(ev.limit(0)).count() == 0
    assert chat.format_chats(ev).count() == 3


def test_repeated_rows_are_messages_of_their_own(spark):
    turns = [(1, 0, "user", "hey"), (1, 0, "user", "hey"), (1, 1, "assistant", "abc"), (1, 1, "assistant", "abc"),
             (1, 2, "assistant", "even"), (1, 2, "assistant", "even"), (1, 2, "assistant", "even"), (1, 3, None, "x"), (1, 3, "x", None),
             (2, 0, "a\nb", "c"), (2, 0, "a", "b\nc")]
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.format_chats(queries.chat_events(rows))).collect()}
    assert [(t.role, t.text) for t in back[1].turns][:7] == [(r, t) for _, _, r, t in turns[:7]]
    assert Counter((t.role, t.text) for k in back for t in back[k].turns) == Counter((r or "", t or "") for _, _, r, t in turns)
    assert back[1].loss_text == "abcabceveneveneven"


def test_texts_of_every_length_are_streamed_or_edited(spark):
    rows = spark.createDataFrame([(k, 0, r, t) for k, (r, t) in enumerate((r, t) for r in ("user", "assistant") for t in ("", "ab", "abc"))],
                                 "conv_id bigint, turn bigint, role string, text string")
    kinds = defaultdict(list)
    for r in queries.chat_events(rows).orderBy("conv_id", "seq").collect():
        kinds[r.conv_id].append(r.kind)
    assert all(kinds[k] == ["message", "edit"] for k in range(3))
    assert all(kinds[k] == ["message", "delta", "regenerate", "delta", "delta"] for k in range(3, 6))


def test_events_delivered_again_count_once(spark):
    log = [(1, 0, "message", "a", "assistant", ""), (1, 1, "delta", "a", None, "x "), (1, 2, "delta", "a", None, "x "),
           (1, 3, "message", "b", "user", "d"), (1, 4, "edit", "b", None, "e"), (1, 5, "message", "c", "user", "u"), (1, 6, "retract", "c", None, None),
           (1, 7, "message", "f", "assistant", "old"), (1, 8, "delta", "f", None, "y"), (1, 9, "regenerate", "f", None, "new "), (1, 10, "delta", "f", None, "z")]
    ev = spark.createDataFrame(log, "conv_id bigint, seq bigint, kind string, message string, role string, text string")
    rows = lambda df: sorted(tuple(r) for r in chat.fold(df).collect())
    once = [(1, 0, "a", "assistant", "x x "), (1, 3, "b", "user", "e"), (1, 7, "f", "assistant", "new z")]
    assert rows(ev) == once and rows(ev.unionAll(ev).repartition(5)) == once
    other_role = ev.withColumn("role", F.when(F.col("kind") == "delta", "assistant").otherwise(F.col("role")))
    assert rows(ev.unionAll(other_role)) == once


def test_long_conversations_take_time_in_proportion(spark):
    """Twice the turns take about twice the time (a quadratic step would take four times), and all spans are right."""
    import time

    def run(n):
        rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.concat(F.lit("wörd </s> "), F.col("id").cast("string")).alias("text"))
        made = chat.format_chats(queries.chat_events(rows)).cache()
        made.count()
        start = time.time()
        back = chat.read_back(made).select("loss_text", F.size("turns").alias("n")).first()
        took = time.time() - start
        whole = made.first()
        made.unpersist()
        want = [f"wörd </s> {k}" for k in range(1, n, 2)]
        assert back.n == n and back.loss_text == "".join(want)
        spans = [whole.formatted[s.start:s.start + s.length] for s in whole.loss_spans]
        assert [x.replace("\\", "") for x in spans] == want
        return took

    run(2000)
    assert run(24_000) < 3.2 * run(12_000) + 1


def test_op6_digests(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    by = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda x: (x[0], x[1])):
        by[c].append((r, x or ""))
    got = {r.conv_id: r for r in queries.QUERIES["op6_chat_format"](spark, SF).collect()}
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(loss) and got[c].formatted_chars > sum(len(x) for _, x in turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


# ---- nearest neighbours

def brute_search(rows, is_query, top=20):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and any(v) and all(x is not None and math.isfinite(x) for x in v):
            ok[i] = min(ok.get(i, tuple(v)), tuple(v))
    out = {}
    for q, v in ok.items():
        if is_query(q):
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok.items() if i != q)
            out[q] = s[:top]
    return out


def test_search_small_tables_exactly(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4).round(2)]) for i in range(70)]
    rows += [(100 + i, rows[3][1]) for i in range(40)] + [(0, rows[0][1])]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (205, []), (220, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"rep": F.lit(1), "V": F.lit(2), "score": F.lit(3)})
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    for frame, ids in ((df, data), (df.where("vec_id < 15"), [x for x in data if x[0] is not None and x[0] < 15])):
        want = brute_search(ids, lambda i: i % 20 == 0)
        got = defaultdict(list)
        for r in ann.search(frame, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.rank, r.vec_id, r.score))
        assert set(got) == set(want)
        for q, found in got.items():
            assert [f[0] for f in found] == list(range(1, len(want[q]) + 1))
            assert [f[2] for f in found] == pytest.approx([-s for s, _ in want[q]], abs=1e-9)
            assert [f[1] for f in found] == [i for _, i in want[q]] or len({round(s, 9) for s, _ in want[q]}) < len(want[q])
    assert ann.search(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_search_recall_and_fallback(spark):
    """Hashed search over a table with clusters and one far-off query, recall against brute force."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(30, 16))
    x = centers[rng.integers(30, size=3000)] + 0.4 * rng.normal(size=(3000, 16))
    x[0] = -50 * centers.sum(0)
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(df, F.col("id") % 20 == 0, ann.AnnParams(sample_rows=1000)).collect():
        got[r.query_id].append(r.vec_id)
    score = x[::20] @ x.T
    score[np.arange(len(score)), np.arange(0, 3000, 20)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert all(len(v) == 20 for v in got.values()) and len(got) == 150
    assert sum(len(set(b) & set(got[20 * i])) for i, b in enumerate(best.tolist())) >= 0.9 * best.size


def test_probes_start_with_the_own_bucket_and_follow_the_cost():
    order = ann.probing_order(3, 100)
    assert order[0] == () and order[1] == (1,) and len(set(order)) == len(order) == 27
    assert all(not (r in s and 7 - r in s) for s in order for r in s)


# ---- licences

def test_licences_own_and_inherited(spark):
    mit, gpl = "Released under the MIT License.", "SPDX-License-Identifier: GPL-3.0"
    files = [(1, "p/LICENSE", mit), (2, "p/a.py", "x = 1"), (3, "p/sub/b.py", None), (4, "p/sub/deep/LICENSE.txt", f"words\n{gpl}\nmore"),
             (5, "p/sub/deep/c.py", ""), (6, "q/d.py", "nothing here"), (7, "p/e.py", "# Licensed under the Apache License, Version 2.0."),
             (8, None, "none"), (9, "top.py", "plain"), (9, "top.py", "plain"), (10, "q/f.py", "word " * 50_000 + "\n# " + gpl),
             (11, "p2/LICENSE", mit), (12, "p2/LICENSE", mit), (13, "p2/x/y/z.py", "y")]
    df = spark.createDataFrame(files, "doc_id bigint, path string, text string").withColumns({"dir": F.lit(1), "licence": F.lit(2), "whole": F.lit(3)})
    got = {r.doc_id: (r.licence, r.origin) for r in licenses.scan(df).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited"), 3: ("MIT", "inherited"), 4: ("GPL-3.0", "own"), 5: ("GPL-3.0", "inherited"),
                   6: (None, "none"), 7: ("Apache-2.0", "own"), 8: (None, "none"), 9: (None, "none"), 10: ("GPL-3.0", "own"),
                   11: ("MIT", "own"), 12: ("MIT", "own"), 13: ("MIT", "inherited")}
    assert licenses.scan(df).count() == len(files) and licenses.scan(df.limit(0)).count() == 0


MIT_TEXT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_TEXT = """Copyright (c) 2015, Some Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
"""
GPL_HEADER = """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 */
int main() {{ return 0; }}
"""
GPL_TEXT = """                    GNU GENERAL PUBLIC LICENSE
                       Version 3, 29 June 2007

 Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>
 Everyone is permitted to copy and distribute verbatim copies
 of this license document, but changing it is not allowed.
""" + "The licenses for most software and other practical works are designed to take away your freedom.\n" * 30


def test_wrapped_and_inline_notices_and_whole_licence_texts(spark):
    filler = [(100 + i, f"z{i}/f.txt", f"plain words number {i} of a file without any notice " * 5) for i in range(60)]
    files = [(1, "a/LICENSE", MIT_TEXT), (2, "b/LICENSE", BSD_TEXT), (3, "c/COPYING", GPL_TEXT), (4, "a/x.py", "x = 1"), (5, "c/y/z.py", None),
             (6, "d/h.py", "".join(f"# {x}\n" for x in BSD_TEXT.split("\n")) + "x = 1\n" * 50),
             (7, "d/g3.c", GPL_HEADER.format("", 3)), (8, "d/g2.c", GPL_HEADER.format("", 2)), (9, "d/lg.c", GPL_HEADER.format("Lesser ", 3)),
             (10, "d/ag.c", GPL_HEADER.format("Affero ", 3)),
             (11, "d/in.js", "Copyright 2020 Foo. Released under the MIT License. See the file for all of the details and so on."),
             (12, "d/ap.go", '// Licensed under the Apache License, Version 2.0 (the "License");\n// you may not use this file except in compliance'),
             (13, "d/no.py", "The program is free and the terms of its use are published by the foundation."),
             (14, "e/p.py", "All rights reserved"), (15, "e/q.py", "Copyright 2015 Foo. All rights reserved. See the file beside this one for more.")]
    df = spark.createDataFrame(files + filler, "doc_id bigint, path string, text string")
    got = {r.doc_id: (r.licence, r.origin) for r in licenses.scan(df).collect() if r.doc_id < 100}
    assert got == {1: ("MIT", "own"), 2: ("BSD-3-Clause", "own"), 3: ("GPL-3.0", "own"), 4: ("MIT", "inherited"), 5: ("GPL-3.0", "inherited"),
                   6: ("BSD-3-Clause", "own"), 7: ("GPL-3.0", "own"), 8: ("GPL-2.0", "own"), 9: ("LGPL-3.0", "own"), 10: ("AGPL-3.0", "own"),
                   11: ("MIT", "own"), 12: ("Apache-2.0", "own"), 13: (None, "none"), 14: ("proprietary", "own"), 15: (None, "none")}


def test_current_identifiers_and_further_licences(spark):
    cut = BSD_TEXT[:BSD_TEXT.index("3. ")] if "3. " in BSD_TEXT else BSD_TEXT
    files = [(1, "a/f.c", "/* SPDX-License-Identifier: GPL-2.0-only */\nint x;"), (2, "b/f.py", "# SPDX-License-Identifier: LGPL-2.1-or-later\n" + "y = 2\n" * 9),
             (3, "c/f", "// SPDX-License-Identifier: BSD-2-Clause"), (4, "d/f", "SPDX-License-Identifier: EPL-2.0"),
             (5, "e/LICENSE", "ISC License\n\nCopyright 2020 Foo\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose "
              "with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"),
             (6, "f/LICENSE", "CC0 1.0 Universal\n\nStatement of Purpose\n\nThe laws of most jurisdictions throughout the world"),
             (7, "g/LICENSE", "BSD 2-Clause License\n\n" + cut), (8, "h/LICENSE", "BSD 3-Clause License\n\n" + BSD_TEXT),
             (9, "i/f", "SPDX-License-Identifier: Unknown-1.0"), (10, "j/f", "SPDX-License-Identifier: GPL-2.0"), (11, "k/f", "// SPDX-License-Identifier: AGPL-3.0-only")]
    files += [(100 + k, f"x/y{k}.txt", f"plain text number {k} about a license of software") for k in range(40)]
    got = {r.doc_id: r.licence for r in licenses.scan(spark.createDataFrame(files, "doc_id bigint, path string, text string")).collect()}
    assert {k: got[k] for k in range(1, 12)} == {
        1: "GPL-2.0", 2: "LGPL-2.1", 3: "BSD-2-Clause", 4: "EPL-2.0", 5: "ISC", 6: "CC0-1.0", 7: "BSD-2-Clause", 8: "BSD-3-Clause", 9: None,
        10: "GPL-2.0", 11: "AGPL-3.0"}
    assert not any(v for k, v in got.items() if k >= 100)


def test_op5_against_brute_force(spark):
    rows = queries.files_of(spark.read.parquet(f"{SF01}/documents.parquet")).collect()
    terms = lambda t: Counter(x for x in licenses._terms((t or "").split()) if x)
    df = Counter()
    for r in rows:
        df.update(set(terms(r.text)))
    idf = lambda t: math.log((1 + len(rows)) / (1 + (df[t] if t in licenses.vocabulary() else 0))) + 1e-9
    vec = lambda c: {t: n * idf(t) for t, n in c.items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    known = [(name, vec(terms(n))) for name in sorted(licenses.TEMPLATES) for n in licenses.TEMPLATES[name]]
    own, where = {}, {}
    for r in rows:
        parts = (r.text or "").split("\n") + ([r.text] if r.path.endswith("LICENSE") else [])
        best = max(((sum(x * v.get(t, 0) for t, x in k.items()) / (norm(v) * norm(k)) if v else 0.0, name)
                    for v in (vec(terms(p)) for p in parts) for name, k in known), key=lambda x: x[0])
        own[r.doc_id] = best[1] if best[0] >= 0.8 else None
        where[r.doc_id] = r.path
    dirs = {where[d].rpartition("/")[0]: x for d, x in own.items() if x and where[d].endswith("LICENSE")}

    def above(d):
        at = where[d].rpartition("/")[0]
        while True:
            if at in dirs:
                return dirs[at]
            if not at:
                return None
            at = at.rpartition("/")[0]
    got = {r.doc_id: r.licence for r in queries.QUERIES["op5_licence_scan"](spark, SF01).collect()}
    assert got == {d: x or above(d) for d, x in own.items()} and any(got.values())


# ---- pipeline

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    stage = dict(corpus_pipeline.STAGES)
    first = stage["quality classifier"](spark, docs, SF01)
    model = quality.fit(docs, spark.read.parquet(f"{SF01}/labels.parquet"))
    keep = {r.doc_id for r in quality.score(docs, model, keep=["doc_id"]).where("score >= 0.5").collect()}
    assert first.columns == columns
    now = sorted(tuple(r) for r in first.collect())
    assert now == sorted(r for r in rows if r[0] in keep) and len(now) > 0.7 * len(rows)
    second = stage["line dedup"](spark, first, SF01)
    assert second.columns == columns
    assert Counter((r.doc_id, r.text) for r in second.collect()) == brute_lines([(d, s, t) for d, t, _, s, _ in now], 0.3, 3)
    from test_llm_text import brute_components, brute_fingerprint
    after = [tuple(r) for r in second.collect()]
    third = stage["simhash near-dedup"](spark, second, SF01)
    comp = brute_components([r[0] for r in after], [brute_fingerprint(r[1]) for r in after], 3)
    assert third.columns == columns
    assert sorted(tuple(r) for r in third.collect()) == sorted(r for r, c in zip(after, comp) if r[0] == c)
    fourth = stage["benchmark decontamination"](spark, third, SF01)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute_leaks([(r.doc_id, r.text) for r in third.collect()], items)}
    assert fourth.columns == columns
    assert {r.doc_id for r in fourth.collect()} == {r.doc_id for r in third.collect()} - bad
    from test_llm_text import check_pieces
    check_pieces(stage["packing"](spark, fourth, SF01).collect(), [(r.doc_id, r.text) for r in fourth.collect()])


def test_pipeline_edge_cases(spark, tmp_path):
    fine = "A fine text of words, long enough. " * 20
    rows = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, fine, "en", "a", 1),
            (3, fine, "en", "a", 1), (None, "no id here at all, but words", "en", "a", 2),
            (None, "no id here at all, but words", "en", "a", 2), (None, fine, "en", "c", 1), (4, "word " * 30_000, "en", "b", 3)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema).withColumns({"Score": F.lit(1), "k0": F.lit(2), "n_lines": F.lit(3), "row": F.lit(4), "row_": F.lit(5)})
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (4, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        now = frame
        for _, f in corpus_pipeline.STAGES[1:4]:
            now = f(spark, now, d)
            assert now.columns == docs.columns
        ids = sorted((r.doc_id for r in now.collect()), key=str)
        assert ids == ([1, 3, 4, None] if frame is docs else [])
        packing.pack(now).count()
        assert corpus_pipeline.STAGES[0][1](spark, frame, d).columns == docs.columns


def test_pipeline_decides_by_row(spark, tmp_path):
    """Reused and missing ids: a near copy or a leak goes, another text under the same id stays."""
    other = " ".join(f"unlike{k}" for k in range(80))
    near = FILL * 30
    rows = [(5, near), (6, near + "x"), (6, other), (7, "Start. " + ITEM + " End."), (7, other + " more of it all"), (None, near), (None, ITEM), (None, other[:300])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.lit("en"), "source": F.lit("a"), "n_chars": F.length("text").cast("long")})
    d = str(tmp_path)
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)
    single = stage["simhash near-dedup"](spark, docs, d)
    from test_llm_text import brute_components, brute_fingerprint
    comp = brute_components(list(range(len(rows))), [brute_fingerprint(t) for _, t in rows], 3)
    groups = {}
    for (i, t), c in zip(rows, comp):
        groups.setdefault(c, []).append((i is None, i, t))
    kept = single.collect()
    assert len(kept) == len(groups) and {r.doc_id for r in kept} >= {5, 6, 7}
    assert Counter((r.doc_id) for r in kept) == Counter(min(g, key=lambda x: (x[0], x[1] or 0))[1] for g in groups.values())
    assert (6, other) in {(r.doc_id, r.text) for r in kept} and (6, near + "x") not in {(r.doc_id, r.text) for r in kept}
    clean = {(r.doc_id, r.text) for r in stage["benchmark decontamination"](spark, docs, d).collect()}
    assert clean == {(i, t) for i, t in rows if ITEM not in t}


def test_pipeline_texts_meet_no_sort_or_aggregate(spark):
    """Stages that drop documents decide on narrow rows: the plan that holds the texts has neither."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for name in ("simhash near-dedup", "benchmark decontamination"):
        plan = dict(corpus_pipeline.STAGES)[name](spark, docs, SF01)._jdf.queryExecution().optimizedPlan().toString()
        physical = dict(corpus_pipeline.STAGES)[name](spark, docs, SF01)._jdf.queryExecution().sparkPlan().toString()
        assert "text" in plan and "SortMergeJoin" not in physical and "ShuffledHashJoin" in physical


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, SF).where("length < 1").count() == 0


def test_simhash_constants_are_the_contract():
    assert (queries.SHINGLE_WORDS, queries.MAX_BITS) == (3, 3) and simhash.covering_masks(3, 0)

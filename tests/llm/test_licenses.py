from inkwell.llm import licenses as C


def scan(spark, rows):
    files = spark.createDataFrame([(i, p, t, "x", 1.0) for i, p, t in rows],
                                  "file long, path string, text string, licence string, score double")
    return {r.file: (r.licence, r.origin, r.directory) for r in C.licences(files).collect()}


def test_notices_files_and_inheritance(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    got = scan(spark, [
        (1, "a/LICENSE", mit), (2, "a/b/LICENSE.txt", apache), (3, "a/x.txt", "text"), (4, "a/b/c/d/y.txt", "text"),
        (5, "a/b/z.txt", "some text\n# " + mit + "\nmore"), (6, "ab/x.txt", "text"), (7, "a/bc/x.txt", "text"),
        (8, "top.txt", "a licence to kill, copyright nobody at all whatsoever in this world"), (9, None, mit),
        (10, "a/b/empty", None), (11, "q/COPYING", "no licence in here, it is only copyright talk of other things"),
        (12, "q/r.txt", "")])
    assert got == {
        1: ("MIT", "file", None), 2: ("Apache-2.0", "file", None), 3: ("MIT", "inherited", "a"),
        4: ("Apache-2.0", "inherited", "a/b"), 5: ("MIT", "notice", None), 6: (None, "none", None),
        7: ("MIT", "inherited", "a"), 8: (None, "none", None), 9: (None, "none", None),
        10: ("Apache-2.0", "inherited", "a/b"), 11: (None, "none", None), 12: (None, "none", None)}


def test_root_licence_repeats_and_empty(spark):
    got = scan(spark, [(1, "LICENSE", "Licensed under CC BY-NC 4.0."), (2, "x/y.txt", "t"), (2, "x/y.txt", "t")])
    assert got == {1: ("CC-BY-NC-4.0", "file", None), 2: ("CC-BY-NC-4.0", "inherited", "")}
    assert scan(spark, []) == {}


LGPL = "                  GNU LESSER GENERAL PUBLIC LICENSE\n                       Version 2.1, February 1999\n"
OPENING = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software"


def test_texts_without_the_word_licence_and_wrapped_headers(spark):
    header = "# " + OPENING.replace("\n", "\n# ") + "\n#\nimport os\nprint(os.getcwd())"
    apache = ("/*\n * Licensed under the Apache\n * License, Version 2.0 (the License); you may\n * not use this file except in\n"
              " * compliance with the License.\n */\nint main() { return 0; }")
    got = scan(spark, [
        (1, "a/LICENSE", "This is free and unencumbered software released into the public domain."),
        (2, "b/LICENSE", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + OPENING), (3, "c/x.py", header),
        (4, "d/COPYING", LGPL), (5, "e/x.c", apache), (6, "a/plain.txt", "nothing of the kind is said here"),
        (7, "f/plain.txt", "a driver holds a permit\nand a fishing permit, free of charge\n\nand a boat")])
    assert got == {1: ("Unlicense", "file", None), 2: ("MIT", "file", None), 3: ("MIT", "notice", None),
                   4: ("LGPL-2.1", "file", None), 5: ("Apache-2.0", "notice", None),
                   6: ("Unlicense", "inherited", "a"), 7: (None, "none", None)}


def test_every_template_is_its_own_best_match(spark):
    rows = [(i, f"{i}/x.txt", "other words\n\n" + text + "\n\nend") for i, (_, text) in enumerate(C.TEMPLATES)]
    got = scan(spark, rows)
    assert {i: r[0] for i, r in got.items()} == {i: name for i, (name, _) in enumerate(C.TEMPLATES)}


def test_ties_own_templates_long_texts_and_two_texts_of_a_file(spark):
    files = spark.createDataFrame(
        [(1, "a/x", "alpha beta gamma", 1), (2, "a/y", "wort für wort " * 50_000 + "\nalpha beta gamma", 2),
         (3, "a/z", "delta", 3), (3, "a/z", "alpha beta gamma", 3), (None, "a/n", "alpha beta gamma", 4)],
        "file long, path string, text string, version long")
    out = C.licences(files, templates=[("second", "alpha beta gamma"), ("first", "gamma beta alpha")]).collect()
    assert sorted((r.file or 0, r.licence) for r in out) == [
        (0, None), (1, "first"), (2, "first"), (3, "first"), (3, "first")]


def test_blocks_against_a_plain_loop(spark):
    import random

    from pyspark.sql import functions as F

    draw = random.Random(5)
    texts = ["\n".join(draw.choice(["# a", "b", "", " \t", "// c", "d e"]) for _ in range(draw.randrange(0, 30))) for _ in range(60)]

    def kind(line):
        return 0 if not line.strip(" \t\r") else 1 if line.lstrip(" \t").startswith(("#", "//")) else 2

    def runs(text):
        lines, out, i = text.split("\n"), [], 0
        while i < len(lines):
            j = i
            while j < len(lines) and kind(lines[j]) == kind(lines[i]):
                j += 1
            if j - i > 1 and kind(lines[i]):
                out.append((-(i + 1), "\n".join(lines[i:j])))
            i = j
        return out

    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string") \
        .select("i", C._blocks(F.split("text", "\n")).alias("b")).collect()
    assert {r.i: [tuple(b) for b in r.b] for r in rows} == {i: runs(t) for i, t in enumerate(texts)}

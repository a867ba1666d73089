import pytest
from comparing import connect, differences
from helpers import documents, empty

from cartwise.llm import licenses


def test_whole_texts_and_lines(spark):
    mit = licenses.KNOWN["MIT"][0]
    other = mit.replace("<year> <copyright holders>", "2024 Somebody").replace("sublicense", "Sub-Licence")
    rows = [(1, mit), (2, "  ".join(other.upper().split(" "))), (3, "Some text.\nreleased under the MIT licence"),
            (4, None), (5, ""), (6, "Copyright 2020 X"), (7, "Released under the MIT License. And more."),
            (7, "Released under the MIT License. And more."), (None, "© me\nRELEASED under the MIT License!!")]
    got = sorted((r.doc_id or 0, r.line, r.license) for r in licenses.scan(documents(spark, rows)).collect())
    assert got == [(0, 0, "MIT-notice"), (0, 2, "MIT-notice"), (1, 0, "MIT"), (2, 0, "MIT"),
                   (3, 2, "MIT-notice")]
    assert licenses.scan(empty(spark)).collect() == []


def test_own_catalogue(spark):
    known = {"B": ["My own terms"], "A": ["my OWN terms!"], "none": ["", "(c) 2000"]}
    assert [(r.license) for r in licenses.catalogue(spark, known).collect()] == ["A"]
    got = licenses.scan(documents(spark, [(1, "My, own, terms")]), known).collect()
    assert sorted((r.line, r.license) for r in got) == [(0, "A"), (1, "A")]


def test_full_texts_rewrapped_and_quoted(spark):
    full = licenses.full_texts()
    mit = licenses.KNOWN["MIT"][0]
    wrapped = mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS")
    rows = [(1, wrapped), (2, mit.replace('"', "\u201d")), (3, mit.partition("\n\n")[2])]
    rows += [(10 + n, " \n".join(full[name][0].split("\n"))) for n, name in enumerate(sorted(full))]
    got = {r.doc_id: r.license for r in licenses.scan(documents(spark, rows)).where("line = 0").collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "MIT", **{10 + n: name for n, name in enumerate(sorted(full))}}


def test_sql_knows_every_text_and_spelling(spark, tmp_path):
    texts = [t for ts in licenses.known_texts().values() for t in ts]
    mit = licenses.KNOWN["MIT"][0]
    rows = list(enumerate([*texts, *(t.upper().replace("\n", " \n * ") for t in texts), *(
        "\u201c" + t.replace("Licens", "Licenc") + "\u201d" for t in texts[:6]),
        mit.replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS OR\nCOPYRIGHT HOLDERS"),
        mit.replace("<year> <copyright holders>", "2024 Somebody\n(c) 1999 me\n# © you"),
        "// Licensed under the Apache License, Version 2.0.\ncode", "none", "", None, "Copyright 2020 X"]))
    documents(spark, rows).write.parquet(f"{tmp_path}/part")
    spark.read.parquet(f"{tmp_path}/part").coalesce(1).write.parquet(f"{tmp_path}/whole")
    (file,) = (tmp_path / "whole").glob("*.parquet")
    folder = tmp_path / "tables"
    folder.mkdir()
    (folder / "documents.parquet").write_bytes(file.read_bytes())
    assert differences(spark, connect(str(folder)), licenses.op7_licenses, licenses.OP7_SQL, str(folder)) == []
    found = {r.doc_id for r in licenses.op7_licenses(spark, str(folder)).where("line = 0").collect()}
    assert set(range(2 * len(texts) + 8)) - found <= {2 * len(texts) + 8}


@pytest.mark.parametrize("name", sorted(licenses.full_texts()))
def test_each_licence_is_in_the_catalogue_under_its_name(name):
    assert licenses.known_texts()[name]

"""CSV by blocks against one reading of the whole file."""

import random

import pytest

from reviewmill.sources import csv, readers


def random_text(r, size):
    return "".join(r.choice(['"', '"', ",", "\n", "\r\n", "\r", "a", "bc", " ", "é", '""', '"x\ny"', '"q, r"']) for _ in range(size))


def rows_of(spark, folder):
    got = {}
    for r in csv.read_rows(spark, str(folder)).orderBy("path", "line").collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.line, list(r.fields)))
    return got


@pytest.mark.parametrize("block", [9, 64, 100_000])
def test_rows_whatever_the_blocks(spark, tmp_path, block):
    r = random.Random(block)
    texts = {f"{k:02d}.csv": ("﻿" if k % 3 == 0 else "") + random_text(r, r.choice([0, 1, 5, 30])) + r.choice(["", "x", "\n"]) for k in range(8)}
    texts["balanced.csv"] = "\n".join(f'{k},"text {k}\nwith a break","{"long " * (k % 9)}"' for k in range(12))
    for name, text in texts.items():
        if text.count('"') % 2:
            text += '"'  # see read_rows on quotes that never close
        texts[name] = text
        (tmp_path / name).write_bytes(text.encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = rows_of(spark, tmp_path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name, text in texts.items():
        want = csv.split_rows(text)
        assert got.get(name, []) == list(enumerate(want, 1)), name


def test_parts_of_a_block_do_not_meet(monkeypatch, spark, tmp_path):
    """Rows are cut while a block is read, not at its end."""
    monkeypatch.setattr(csv, "CHUNK", 30)
    text = "\n".join(f'a{k},"b\n{k}"' for k in range(300))
    (tmp_path / "x.csv").write_text(text)
    assert rows_of(spark, tmp_path)["x.csv"] == list(enumerate(csv.split_rows(text), 1))


def test_reviews_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Author_Name, RATING ,date,text,text\nAnn,05,2024,first,second\n\nBob,6,2024\nCy,5, ,"x\r\ny"\n', newline="")
    (tmp_path / "blank.csv").write_text("\n \n")
    got = sorted((r.path.rsplit("/", 1)[1], r.line, r.author_name, r.rating, r.text, r.reject_reason) for r in readers.read_csv(spark, str(tmp_path)).collect())
    assert got == [
        ("a.csv", 2, "Ann", "05", "second", None), ("a.csv", 3, "Bob", "6", None, "rating"), ("a.csv", 4, "Cy", "5", None, "date"),
        ("blank.csv", 1, None, None, None, "missing column author_name"),
    ]
    assert readers.read_csv(spark, str(tmp_path), cap=1).where("path LIKE '%/a.csv'").count() == 1

"""Answers are kept slice by slice: what was answered before a failure is not asked again."""

from __future__ import annotations

import os
import time
import uuid
from collections import Counter

import pytest

from shelfmark.operators import answers as an


class Fragile:
    """Answers by rule, notes every prompt it has answered, and dies with its process at one prompt."""

    def __init__(self, folder, dies_at=None, wait=0.0):
        self.folder, self.dies_at, self.wait = str(folder), dies_at, wait

    def __call__(self, prompts):
        if self.dies_at in prompts:
            time.sleep(self.wait)
            os._exit(1)
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            f.write("\n".join(prompts))
        return [p.upper() for p in prompts]


def answered(folder):
    return Counter(p for f in folder.iterdir() for p in f.read_text().split("\n"))


@pytest.mark.parametrize("width", [1, 3])
def test_a_task_that_dies_halfway(spark, tmp_path, width):
    noted, table = tmp_path / "noted", str(tmp_path / "answers")
    noted.mkdir()
    asked = spark.createDataFrame([(f"prompt {i % 40}",) for i in range(60)], "prompt string")
    numbered = an.with_request_hash(asked).selectExpr("prompt", "pmod(xxhash64(request_hash), 10) AS slice")
    doomed = numbered.where("slice = 5").first()["prompt"]
    with pytest.raises(Exception):
        an.stored_answers(asked, Fragile(noted, doomed, wait=6.0), table, width, 4)
    before = answered(noted)
    assert 0 < len(before) < 40
    out = an.stored_answers(asked, Fragile(noted), table, width, 4).collect()
    assert Counter(r.response for r in out) == Counter(f"PROMPT {i % 40}" for i in range(60))
    assert set(answered(noted).values()) == {1}, "no answered prompt is asked twice"
    # everything is known now
    assert an.stored_answers(asked, Fragile(noted, "prompt 0"), table, width, 4).count() == 60


def test_slices_bound_a_call(spark, tmp_path):
    noted, table = tmp_path / "noted", str(tmp_path / "answers")
    noted.mkdir()
    asked = spark.createDataFrame([(f"p{i}",) for i in range(200)], "prompt string")
    assert an.ask_in_slices(asked, Fragile(noted), table, 4, 10) == 200
    sizes = [len(f.read_text().split("\n")) for f in noted.iterdir()]
    assert sum(sizes) == 200 and max(sizes) < 40
    files = [f for f in os.listdir(table) if f.endswith(".parquet")]
    assert len(files) >= len(sizes), "a file for each slice"
    assert an.ask_in_slices(asked.limit(0), Fragile(noted, "p0"), table, 4, 10) == 0
    assert an.stored_answers(asked.limit(0), Fragile(noted), str(tmp_path / "new")).collect() == []


def test_null_prompts_and_failures(spark, tmp_path):
    noted = tmp_path / "noted"
    noted.mkdir()

    def model(prompts):
        if "bad" in prompts:
            raise RuntimeError("no")
        return [None if p == "silent" else p for p in prompts]

    asked = spark.createDataFrame([("a", 1), ("bad", 2), ("silent", 3), ("a", 4)], "prompt string, k int")
    out = {r.k: (r.response, r.error) for r in an.stored_answers(asked, model, str(tmp_path / "t"), 2, 2).collect()}
    assert out == {1: ("a", None), 2: (None, "no"), 3: (None, None), 4: ("a", None)}

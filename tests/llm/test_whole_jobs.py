"""Operators where a cut or an outlier could take part of the job away."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairwright.llm import embeddings, pages, pii, secrets
from tests.llm.test_groups import MAIN, PAGE

CHARS = np.array(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"))


def random_keys(rows, seed, alphabet=CHARS):
    draw = np.random.default_rng(seed)
    return ["".join(draw.choice(alphabet, draw.integers(20, 41))) for _ in range(rows)]


def test_keys_without_label_do_not_hide_others(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = random_keys(60, 1) + random_keys(20, 2, CHARS[:26]) + [f"{i * 2654435761 % (1 << 32):08x}" for i in range(60)]
    keyed = spark.createDataFrame([(10**6 + i, f"the key {k} is here") for i, k in enumerate(planted)], docs.schema)
    test = secrets.learn_randomness(docs.unionByName(keyed))
    found = sum(bool(test.added(f"new {k} here", [])) for k in random_keys(500, 3))
    assert found >= 475
    for word in ("einheitheitschenieaupfundden1", "the.thing.of.the.ending.2"):
        assert test.added(f"name {word} here", []) == []
    rows = secrets.scan_secrets(keyed, test).where(F.size("spans") > 0).count()
    assert rows >= 57


def test_parts_of_one_chunk_stand_any_order():
    draw = np.random.default_rng(8)
    base = draw.standard_normal((6, 16))
    data = [(base[i % 6] + 0.05 * draw.standard_normal(16)).astype("<f8").tobytes() for i in range(60)]
    side = pd.DataFrame({"node": np.arange(100, 160), "n": draw.integers(1, 4, 60), "data": data, "side": 0, "a": 0, "b": 0})
    cells = embeddings.fit_cells(16, 60, np.zeros((0, 16)), 1, 0.9, 100)
    parts = {
        "one chunk with itself": side,
        "two chunks": pd.concat([side, side.assign(node=side["node"] + 100, side=1)]).assign(b=1),
        "homes and guests": pd.concat([side, side.assign(node=side["node"] + 100, side=1)]),
    }
    for part in parts.values():
        want = embeddings._part_links(part, cells, 0, False, 0.9)
        for seed in range(3):
            got = embeddings._part_links(part.sample(frac=1, random_state=seed), cells, 0, False, 0.9)
            assert sorted(got.itertuples(index=False)) == sorted(want.itertuples(index=False))
    counts = dict(zip(*embeddings._part_links(side, cells, 0, False, 0.9)[["node", "links"]].values.T))
    unit = np.stack([np.frombuffer(d, "<f8") for d in data])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.9) & ~np.eye(60, dtype=bool)
    assert [counts.get(100 + i, 0) for i in range(60)] == (near @ side["n"].to_numpy()).tolist()


def test_rewritten_data_is_in_the_lattice(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    given = ["ann@mail.com", "ann.m_lee7+x@mail3.sub.example.com", "10.20.30.40", "4111 1111 1111 1111", "+1 (017) 555-7713"]
    examples = []
    for value in given:
        text = f"please note {value} for it"
        for choice in range(30):
            examples += pii.training_examples(text, pii.base_pii(text), choice)
    pii.train_field(examples, epochs=0, strict=True)
    with pytest.raises(ValueError):
        pii.train_field([("a b c d 1", [("email", 0, 9)])], epochs=0, strict=True)
    field = pii.learn_field(docs)
    for host in ("(at) mail (dot) com", "[at] mail [dot] com", "@ mail.com", "at mail Dot com", "[at]mail[dot]com"):
        for space in (" ",) if host[1] != "a" or " " in host else ("",):
            text = f"please write to jane.doe{space}{host} soon"
            want = [("email", 16, len(text) - 5)]
            assert field.added(text, pii.base_pii(text)) == want, text


def test_rare_labels_are_found_in_all_rows(spark, monkeypatch):
    plain = [(i, f"plain words number {i} without a mark") for i in range(3000)]
    marked = [(4000 + i, f"mail a{i}@example.com or token = abcdef{i}x") for i in range(3)]
    docs = spark.createDataFrame(plain + marked, "doc_id long, text string").repartition(4)
    seen = {}
    monkeypatch.setattr(pii, "train_field", lambda examples: seen.update(pii=examples))
    monkeypatch.setattr(secrets, "fit_randomness", lambda random, ordinary: seen.update(random=random, ordinary=ordinary))
    pii.learn_field(docs, sample_windows=20)
    assert sum(bool(spans) for _, spans in seen["pii"]) == 3 * (1 + pii.VERSIONS)
    assert sum(not spans for _, spans in seen["pii"]) == 20
    secrets.learn_randomness(docs, sample_strings=5)
    assert sorted(seen["random"]) == [f"abcdef{i}x" for i in range(3)] and len(seen["ordinary"]) == 5
    divs = [(i, f"<div><p>page {i}</p></div>", "") for i in range(2000)]
    named = [(3000 + i, PAGE.replace("Great", f"Great {i}"), "") for i in range(30)]
    given = spark.createDataFrame(divs + named, "page_id long, html string, text string").repartition(4)
    with monkeypatch.context() as patch:
        patch.setattr(pages, "train_blocks", lambda examples: seen.update(pages=examples))
        pages.learn_blocks(given, sample_pages=25)
    assert len(seen["pages"]) == 25 * 4
    field = pages.learn_blocks(given.where("page_id < 3000"))
    one = pages.extract_pages(spark.createDataFrame([(1, PAGE)], "page_id long, html string"), field).first()
    lines = one.main.text.split("\n")
    assert set(lines) <= set(MAIN.split("\n")) and len(lines) >= 4

"""All stages on planted documents, and the registered queries on the smallest tables."""

import base64
import hashlib
import random

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

import __spark_entry__  # noqa: E402
import corpus_pipeline  # noqa: E402
from tablewright.llm.queries import ORACLES, QUERIES  # noqa: E402
from tests.llm.conftest import EDGES  # noqa: E402
from tests.llm.test_texts import toxic_rows  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def planted(tmp_path_factory):
    """A folder of tables: clean texts, toxic ones, near copies, benchmark passages, personal data, edge rows."""
    import duckdb

    pick = random.Random(12)
    rows, labels = toxic_rows(600)
    kinds = {i: "toxic" if i % 6 == 0 else "clean" for i, _ in rows}
    item = " ".join(f"item{k}" for k in range(30))
    for i in range(1000, 1010):
        words = [f"base{pick.randrange(400)}" for _ in range(120)]
        rows += [(i, " ".join(words)), (i + 100, "  ".join(words).title() + "\n"), (i + 200, " ".join(words))]
        kinds |= {i: "clean", i + 100: "copy", i + 200: "copy"}
    for i in range(1400, 1405):
        text = [f"own{pick.randrange(10**6)}" for _ in range(60)]
        text[20:20] = item.split()[15:] + ["between"] + item.split()[:15]
        rows.append((i, " ".join(text)))
        kinds[i] = "leak"
    for i in range(1500, 1505):
        rows.append((i, f"Reach {' '.join(f'p{pick.randrange(10**6)}' for _ in range(20))} at me{i}@mail.org or +1 (555) 555-12{i % 100:02d} soon."))
        kinds[i] = "private"
    rows += [(2000 + k, t) for k, (_, t) in enumerate(EDGES)]
    path = tmp_path_factory.mktemp("planted")
    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT, \"key\" VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, 'en', 's', ?, 'clash')", [(i, t, None if t is None else len(t)) for i, t in rows])
    con.execute("CREATE TABLE l (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO l VALUES (?, 1, ?)", labels)
    con.execute("CREATE TABLE b (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO b VALUES (?, ?)", [(0, item), (1, None), (2, "short")])
    for name, table in (("documents", "d"), ("labels", "l"), ("benchmark", "b")):
        con.execute(f"COPY {table} TO '{path}/{name}.parquet' (FORMAT parquet)")
    return str(path), dict(rows), kinds


def test_each_stage_takes_effect(spark, planted):
    folder, texts, kinds = planted
    source = spark.read.parquet(f"{folder}/documents.parquet")
    docs, ids = source, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), source.schema)
        assert docs.columns == source.columns
        ids[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    gone = {i for i, k in kinds.items() if k == "toxic"}
    assert set(texts) - ids["toxicity"] == gone
    removed = ids["toxicity"] - ids["simhash_near_dedup"]
    # the copies, and all but one of the edge texts that are equal or have no words
    assert removed - {i for i in texts if i >= 2000} == {i for i, k in kinds.items() if k == "copy"}
    assert {i for i in removed if i >= 2000} == {2001, 2003, 2004, 2005}
    assert ids["simhash_near_dedup"] - ids["decontamination"] == {i for i, k in kinds.items() if k == "leak"}
    assert ids["pii"] == ids["decontamination"]
    after = {r.doc_id: r.text for r in docs.collect()}
    assert all("@" not in after[i] and "555" not in after[i] and "[EMAIL]" in after[i] for i, k in kinds.items() if k == "private")
    assert all(after[i] == texts[i] for i, k in kinds.items() if k == "clean")


def test_the_whole_run(spark, planted):
    import tiktoken

    folder, texts, kinds = planted
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=table, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    kept = {i for i, k in kinds.items() if k in ("clean", "private")}
    assert {i for i in got if i < 2000} == kept
    for i in (i for i in kept if kinds[i] == "clean"):
        raw = np.array(library.encode_ordinary(texts[i]), dtype="<u4").tobytes()
        assert got[i].ids_sha256 == hashlib.sha256(raw).hexdigest() and got[i].n_tokens == len(raw) // 4
        assert got[i].decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()


@pytest.mark.parametrize("name", list(QUERIES))
def test_registered_queries(spark, name):
    """Each operator is registered once, runs on the smallest tables, and agrees with its SQL if it has one."""
    assert __spark_entry__.queries()[name] is QUERIES[name]
    result = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(result, connect(SF), ORACLES[name]) == []
    else:
        assert result.count() > 0


def test_all_operators_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in __spark_entry__.queries()


def test_native_plan_has_no_python(spark):
    plan = QUERIES["op2_license_scan"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

"""State in parts, ids across deliveries, columns by name."""

import dataclasses
import math
import random
from pathlib import Path

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from churnflow.functions import ordered
from churnflow.operators import features, partial, profile, sparse
from churnflow.sources.seen_ids import SeenIds
from churnflow.sources.tables import read_csv
from churnflow.sources.views import view
from churnflow.streaming.monitoring import run_to_table
from tests.rows import SPEC


def close(a: features.PrepState, b: features.PrepState) -> bool:
    return a.modes == b.modes and a.vocabulary == b.vocabulary and all(
        a.numericals[c].median == s.median and a.numericals[c].mean == pytest.approx(s.mean, rel=1e-12) and a.numericals[c].std == pytest.approx(s.std, rel=1e-9)
        for c, s in b.numericals.items())


@pytest.mark.parametrize("slices", [4])
def test_parts_merge_to_the_state_of_all_rows(spark, sf_dir, tmp_path, monkeypatch, slices):
    monkeypatch.setattr(partial, "SLICES", slices)
    rows = view(spark, sf_dir, "subscribers").withColumn("part", F.abs(F.hash("customerID")) % 3)
    state = partial.StateParts(spark, str(tmp_path / "parts"), SPEC)
    for number in range(3):
        state.add(rows.where(F.col("part") == number).drop("part"), f"d{number}")
    whole = features.fit_state(rows.drop("part"), SPEC)
    assert close(state.merged(), whole)
    # A delivery that comes again replaces its part.
    state.add(rows.where("part = 1").drop("part"), "d1")
    assert close(state.merged(), whole)


def test_merging_reads_no_row_again(spark, sf_dir, tmp_path):
    rows = view(spark, sf_dir, "subscribers")
    rows.where("tenure > 20").write.parquet(str(tmp_path / "first"))
    state = partial.StateParts(spark, str(tmp_path / "parts"), SPEC)
    state.add(spark.read.parquet(str(tmp_path / "first")), "first")
    for file in (tmp_path / "first").iterdir():
        file.write_bytes(b"gone")
    state.add(rows.where("tenure <= 20"), "second")
    assert close(state.merged(), features.fit_state(rows, SPEC))


@pytest.mark.parametrize("seed", range(4))
def test_odd_numbers_in_parts(spark, tmp_path, seed):
    """Gaps, ties, zeros of both signs, values far from those of the first delivery, columns without values in one."""
    rng = random.Random(seed)
    spec = dataclasses.replace(SPEC, numericals=("a", "b"), categories={"c": ("x", "y")})
    parts = []
    for number in range(3):
        far = 10.0 ** (3 * number)
        parts.append([(rng.choice([None, 0.0, -0.0, 1.5, far, far + rng.random()]), None if number == 0 else rng.random(), rng.choice(["x", "y", None]))
                      for _ in range(rng.randint(5, 40))])
    frames = [spark.createDataFrame(p, "a double, b double, c string") for p in parts]
    state = partial.StateParts(spark, str(tmp_path / "parts"), spec)
    for number, frame in enumerate(frames):
        state.add(frame, str(number))
    whole = features.fit_state(frames[0].unionByName(frames[1]).unionByName(frames[2]), spec)
    assert close(state.merged(), whole)


def test_parts_without_values(spark, tmp_path):
    spec = dataclasses.replace(SPEC, numericals=("a",), categories={"c": ("x",)})
    state = partial.StateParts(spark, str(tmp_path / "parts"), spec)
    state.add(spark.createDataFrame([(None, "x")], "a double, c string"), "0")
    with pytest.raises(ValueError, match="has no values to fit on"):
        state.merged()
    state.add(spark.createDataFrame([(float("inf"), "x")], "a double, c string"), "1")
    with pytest.raises(ValueError, match="infinity"):
        state.merged()
    with pytest.raises(FileNotFoundError):
        partial.StateParts(spark, str(tmp_path / "none"), spec).merged()


@pytest.mark.parametrize("one_sort", [0, 200_000])
def test_medians_of_skewed_columns(spark, monkeypatch, one_sort):
    """Far values, gaps and ties, with the interval sorted as it is or in slices."""
    monkeypatch.setattr(ordered, "ONE_SORT", one_sort)
    import statistics

    rng = random.Random(5)
    columns = {
        "far": [rng.random() for _ in range(2000)] + [1e300, -1e300],
        "groups": [rng.random() for _ in range(1001)] + [1e12 + rng.random() for _ in range(1001)],
        "ties": [1.0] * 1500 + [2.0] * 502, "one": [7.0] * 2002, "tail": [rng.paretovariate(0.3) for _ in range(2002)],
    }
    rows = list(zip(*columns.values()))
    frame = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    found, _ = ordered.exact_medians(frame, list(columns), accuracy=100)
    assert found == {c: statistics.median(v) for c, v in columns.items()}


def test_slices_hold_about_as_many_values(spark):
    values = [float(i) for i in range(20_000)] + [1e15]
    counted = spark.createDataFrame([("c", v, 1) for v in values], "name string, value double, n bigint")
    sizes = counted.withColumn("slice", ordered._slices(counted, ["c"])).groupBy("slice").count().collect()
    assert len(sizes) > 250 and max(r["count"] for r in sizes) < 200


def deliveries(spark):
    return [
        spark.createDataFrame(rows, "id string, x int")
        for rows in ([("a", 1), ("b", 1), ("b", 2), (None, 3)], [("b", 1), ("c", 1), (None, 1), (None, 2), ("", 5)], [], [("=", 1), ("", 2), ("d", 3), ("d", 4)])
    ]


def test_ids_across_deliveries(spark, tmp_path):
    index = SeenIds(spark, str(tmp_path / "ids"), 4)
    found = []
    for number, df in enumerate(deliveries(spark)):
        found.append(tuple(index.counts(df, "id").first()))
        index.add(df, "id", str(number))
        index.add(df, "id", f"{number} again")
    # Rows, rows beyond the first of their id, rows whose id came before; missing ids count as equal.
    assert found == [(4, 1, 0), (5, 3, 3), (0, 0, 0), (4, 2, 1)]
    judged = {r["id"]: (r["rows"], r["first"]) for r in index.judged(deliveries(spark)[1], "id").collect()}
    assert judged == {"b": (1, "0"), "c": (1, "1"), None: (2, "0"), "": (1, "1")}


def test_index_of_another_session(spark, tmp_path):
    """The files are enough: a session that doesn't know the table reads the same buckets."""
    index = SeenIds(spark, str(tmp_path / "ids"), 4)
    index.add(deliveries(spark)[0], "id", "0")
    spark.sql(f"DROP TABLE {index._name}")
    again = SeenIds(spark, str(tmp_path / "ids"), 4)
    assert tuple(again.counts(deliveries(spark)[1], "id").first()) == (5, 3, 3)


def test_the_index_is_not_moved(spark, tmp_path):
    index = SeenIds(spark, str(tmp_path / "ids"), 4)
    index.add(spark.range(1000).selectExpr("cast(id as string) AS id"), "id", "0")
    judged = index.judged(spark.range(500, 600).selectExpr("cast(id as string) AS id"), "id")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("seen_ids_") - 400 :]
    assert "Bucketed: true" in plan and plan.count("Exchange") == plan.count("hashpartitioning") and "Broadcast" not in plan
    scan = next(line for line in plan.splitlines() if "seen_ids_" in line)
    above = plan.splitlines()[: plan.splitlines().index(scan)][::-1]
    depth = len(scan) - len(scan.lstrip(" :+-*()0123456789"))
    for line in above:
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            depth = own
            assert "Exchange" not in line or "SortMergeJoin" in line, side
        if "SortMergeJoin" in line:
            break


def write(folder: Path, **files: str) -> str:
    folder.mkdir()
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_cells_follow_their_names(spark, tmp_path):
    path = write(tmp_path / "t", a='x,y\n1,2\n"3",NA\n', b="y,x\n20,10\n", c='"y","x"\r\n40,30\r\n', d="x,y\n")
    assert sorted((r.x, r.y) for r in read_csv(spark, path).collect()) == [("1", "2"), ("10", "20"), ("3", None), ("30", "40")]
    assert sorted((r.x, r.y) for r in read_csv(spark, path, multiline=True).collect()) == [("1", "2"), ("10", "20"), ("3", None), ("30", "40")]


@pytest.mark.parametrize("other", ["x,z\n5,6\n", "x\n5\n", "x,y,z\n5,6,7\n"])
def test_files_with_other_columns_fail(spark, tmp_path, other):
    path = write(tmp_path / "t", a="x,y\n1,2\n", b=other)
    with pytest.raises(ValueError, match="different columns"):
        read_csv(spark, path)


def test_many_files_with_one_header(spark, tmp_path):
    path = write(tmp_path / "t", **{f"f{i}": f"\n\nx,y\n{i},{-i}\n" for i in range(12)})
    assert sorted((int(r.x), int(r.y)) for r in read_csv(spark, path).collect()) == [(i, -i) for i in range(12)]


def test_records_over_lines(spark, tmp_path):
    """Quoted line breaks, blank lines inside and between records, files of several stretches, columns in other orders."""
    rng = random.Random(2)
    rows, text = [], {}
    for f, header in enumerate(("id,note", "note,id", '"id","note"')):
        lines = ["", header]
        for i in range(400):
            note = "".join(rng.choice(['a', '"', ",", "\n", "é", "\n\n"]) for _ in range(rng.randint(0, 12))) + "z"
            rows.append((f"{f}-{i}", note))
            cells = {"id": f"{f}-{i}", "note": '"' + note.replace('"', '""') + '"'}
            lines.append(",".join(cells[c] for c in ("id", "note")[:: -1 if f == 1 else 1]))
            lines += [""] * rng.randint(0, 1)
        text[f"f{f}"] = "\n".join(lines) + ("\n" if f else "")
    path = write(tmp_path / "t", **text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        df = read_csv(spark, path, multiline=True)
        assert sorted((r.id, r.note) for r in df.collect()) == sorted(rows)
        # Several tasks to a file.
        assert spark.read.text(path).rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_lone_quote_fails(spark, tmp_path):
    path = write(tmp_path / "t", a='x,y\n1,5" pipe\n2,b\n3,6" pipe\n')
    with pytest.raises(Exception, match="more cells than its header"):
        read_csv(spark, path, multiline=True).collect()


def test_footers_tell_what_is_missing(spark, tmp_path):
    rows = [(1, None, float("nan"), "a"), (None, "x", 2.0, None), (3, "", None, "b")]
    df = spark.createDataFrame(rows * 50, "a int, `b.c` string, d double, e string")
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    found = {r["column"]: r["missing"] for r in profile.stored_missing_counts(spark, str(tmp_path / "t")).collect()}
    assert found == {"a": 50, "b.c": 50, "d": 100, "e": 50, None: 150}
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = profile.footer_counts(session.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(a)" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_sparse_model(spark, tmp_path):
    """Learns from the category alone, treats unseen ones and gaps alike on batch and stream, after being saved."""
    rng = random.Random(7)
    good = {f"p{i}": rng.random() < 0.5 for i in range(300)}
    rows = [(p, rng.random(), int(good[p] != (rng.random() < 0.05))) for p in rng.choices(list(good), k=6000)]
    df = spark.createDataFrame(rows, "part string, x double, label int")
    model = sparse.fit_sparse_model(df, "label", ["part"], ["x"], iterations=10)
    loaded = sparse.SparseModel.load(spark, model.save(str(tmp_path / "m")))
    judged = loaded.scored(df)
    assert judged.columns == ["part", "x", "label", "score"]
    assert judged.where("(score > 0.5) = (label = 1)").count() > 0.9 * 6000
    odd = spark.createDataFrame([("p1", 0.5, 1), ("unseen", 0.5, 1), (None, 0.5, 0), ("also unseen", 0.5, 0)], "part string, x double, label int")
    by_part = {r.part: r.score for r in loaded.scored(odd).collect()}
    mode = loaded.state.modes.first()["category"]
    assert by_part["unseen"] == by_part["also unseen"] != by_part["p1"]
    assert by_part[None] == loaded.scored(spark.createDataFrame([(mode, 0.5)], "part string, x double")).first()["score"]
    odd.write.parquet(str(tmp_path / "in"))
    stream = loaded.scored(spark.readStream.schema(odd.schema).parquet(str(tmp_path / "in")))
    run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert {r.part: r.score for r in spark.read.parquet(str(tmp_path / "out")).collect()} == by_part


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_places_in_the_vocabulary(spark, monkeypatch, broadcast):
    monkeypatch.setattr(sparse, "BROADCAST", broadcast)
    df = spark.createDataFrame([("b", 2), ("a", 10), ("b", None), (None, 10)], "s string, `n.m` int")
    state = sparse.fit_sparse(df, ["s", "n.m"])
    found = sparse.indexed(df.unionByName(spark.createDataFrame([("z", 7)], df.schema)), state).collect()
    assert sorted((r["__index_s"], r["__index_n.m"]) for r in found) == [(0.0, 0.0), (1.0, 0.0), (1.0, 0.0), (1.0, 1.0), (2.0, 2.0)]


def test_sparse_model_is_a_table(spark, tmp_path):
    """The driver holds numbers and an intercept alone, and the fit ends where Spark's own logistic regression does."""
    rng = random.Random(3)
    effect = {**{f"a{i}": rng.gauss(0, 2) for i in range(25)}, **{f"b{i}": rng.gauss(0, 1) for i in range(4)}}
    drawn = [(f"a{int(rng.random() ** 2 * 25)}", f"b{rng.randrange(4)}", 500 + 100 * rng.random(), 7.0) for _ in range(800)]
    rows = [(a, b, x, u, int(rng.random() < 1 / (1 + math.exp(-(effect[a] + effect[b] + (x - 550) / 30))))) for a, b, x, u in drawn]
    df = spark.createDataFrame(rows, "a string, b string, x double, same double, label int")
    model = sparse.fit_sparse_model(df, "label", ["a", "b"], ["x", "same"], 2.5, 20, 1e-2)
    assert model.weights.columns == ["column", "category", "weight"]
    assert model.weights.count() == df.select("a").distinct().count() + df.select("b").distinct().count()
    assert set(model.numbers) == {"x", "same"} and model.numbers["same"] == 0
    hot = [F.when(F.col(c) == v, 1.0).otherwise(0.0).alias(v) for c, values in (("a", 25), ("b", 4)) for v in (f"{c}{i}" for i in range(values))]
    weight = F.when(F.col("label") == 1, 2.5).otherwise(1.0).alias("weight")
    wide = VectorAssembler(inputCols=["x", *effect], outputCol="features").transform(df.select("*", weight, *hot))
    plain = LogisticRegression(weightCol="weight", regParam=1e-2, maxIter=300, tol=1e-12).fit(wide)
    both = model.scored(plain.transform(wide).select(*df.columns, vector_to_array("probability")[1].alias("plain")))
    assert both.where("abs(score - plain) > 1e-5").isEmpty()
    loaded = sparse.SparseModel.load(spark, model.save(str(tmp_path / "m")))
    assert (loaded.numbers, loaded.intercept) == (model.numbers, model.intercept)


def test_sparse_model_of_one_label(spark):
    for label in (0, 1):
        df = spark.createDataFrame([("p", 1.0, label), ("q", 2.0, label)], "part string, x double, label int")
        assert {r.score for r in sparse.fit_sparse_model(df, "label", ["part"], ["x"]).scored(df).collect()} == {float(label)}


@pytest.mark.parametrize("row", [("p", None, 1), ("p", 1.0, None), ("p", 1.0, 2)])
def test_sparse_model_needs_numbers_and_labels(spark, row):
    df = spark.createDataFrame([("p", 1.0, 0), ("q", 2.0, 1), row], "part string, x double, label int")
    with pytest.raises(Exception, match="is missing|neither 0 nor 1"):
        sparse.fit_sparse_model(df, "label", ["part"], ["x"])

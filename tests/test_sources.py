import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from affinia.operators import baskets
from affinia.operators import profile as prof
from affinia.operators import summaries as summ
from affinia.operators.bfr import BfrSettings, run_chunks
from affinia.sources import readers, writers


@pytest.fixture
def place(tmp_path):
    def write(name, text):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part").write_text(text)
        return str(folder)

    write.out = lambda name: str(tmp_path / name)
    return write


def written(spark, path):
    return [r[0] for r in spark.read.text(path).collect()]


def test_adjacency(spark, place):
    path = place("adj", "1\t2,3,3\n2\t\n3\n\n4\tx,1\nabc\t1\n1\t5\n 6\t 1 \n")
    vertices, edges, rejects = readers.read_adjacency(spark, path)
    assert sorted(r[0] for r in vertices.collect()) == [1, 2, 3, 6]
    assert sorted(map(tuple, edges.collect())) == [(1, 2), (1, 3), (1, 5), (6, 1)]
    assert sorted(r[0] for r in rejects.collect()) == ["", "4\tx,1", "abc\t1"]


def test_long_neighbour_lists_go_on_in_further_lines(spark, place):
    vertices = spark.range(3).select("id")
    edges = spark.range(100).selectExpr("0 AS src", "id + 1 AS dst")
    path = place.out("adj-out")
    writers.write_adjacency(vertices, edges, path, per_line=10)
    assert len(written(spark, path)) > 5
    back = readers.read_adjacency(spark, path)
    assert back.vertices.count() == 3 and back.edges.count() == 100


def test_transactions_with_quotes_repeated_header_and_bad_line(spark, place):
    head = "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION"
    path = place("tx", f'{head}\n,,p1,,10,"Viral, ""acute"""\n{head}\n,,p2,,11,Plain\nonly,two\n')
    rows, rejects = readers.read_transactions(spark, path)
    assert sorted(map(tuple, rows.collect())) == [("p1", "10", 'Viral, "acute"'), ("p2", "11", "Plain")]
    assert [r[0] for r in rejects.collect()] == ["only,two"]


def test_ratings_with_and_without_header(spark, place):
    colons = place("a", "1::10::4.5::978300760\n2::10::x::1\n")
    rows, rejects = readers.read_ratings(spark, colons)
    assert [tuple(r) for r in rows.collect()] == [(1, 10, 4.5, 978300760)]
    assert [r[0] for r in rejects.collect()] == ["2::10::x::1"]
    commas = place("b", "userId,movieId,rating,timestamp\n1,10,4.5,7\n")
    rows, rejects = readers.read_ratings(spark, commas, ",", ["userId", "movieId", "rating", "timestamp"])
    assert [tuple(r) for r in rows.collect()] == [(1, 10, 4.5, 7)] and rejects.count() == 0
    titled = place("c", "1::Toy Story (1995)::Animation|Comedy\n")
    assert tuple(readers.read_items(spark, titled).rows.first()) == (1, "Toy Story (1995)", "Animation|Comedy")


def test_features_under_three_header_lines(spark, place):
    path = place("f", "feature,a,a,b\nstatistics,mean,std,mean\nnumber,01,01,02\ntrack_id,,,\n2,1.5,2,3\n3,1,,2\nx9,4.0,5.0,1\n,6.0,7.0,1\n")
    rows, rejects = readers.read_features(spark, path)
    assert [tuple(r) for r in rows.collect()] == [(2, [1.5, 2.0, 3.0])]
    assert sorted(r[0] for r in rejects.collect()) == [",6.0,7.0,1", "3,1,,2", "x9,4.0,5.0,1"]
    names = readers.read_feature_names(spark, path)
    assert names == ["a__mean__01", "a__std__01", "b__mean__02"]
    assert readers.statistic_features(rows, names, "mean").first()["features"] == [1.5, 3.0]


def test_labels_under_two_header_lines(spark, place):
    path = place("l", ',album,set,track\n,title,subset,genre_top\ntrack_id,,,\n2,"a, b",small,Rock\n3,c,large,\nbad,c,large,\n')
    rows, rejects = readers.read_labels(spark, path)
    assert sorted(map(tuple, rows.collect())) == [(2, "small", "Rock"), (3, "large", None)]
    assert [r[0] for r in rejects.collect()] == ["bad,c,large,"]


def test_labels_with_quoted_line_breaks_and_open_quotes(spark, place):
    head = ",album,set,track\n,title,subset,genre_top\ntrack_id,,,\n"
    path = place("lb", head + '2,"a\nb",small,Rock\n,x,y,z\n')
    rows, rejects = readers.read_labels(spark, path)
    assert [tuple(r) for r in rows.collect()] == [(2, "small", "Rock")]
    assert [r[0] for r in rejects.collect()] == [",x,y,z"]
    rows, rejects = readers.read_labels(spark, path, multi_line=False)
    assert rows.count() == 0
    assert sorted(r[0] for r in rejects.collect()) == [",x,y,z", '2,"a', 'b",small,Rock']


@pytest.mark.parametrize("longest", [10_000, 2])
def test_quoted_records_of_a_file_in_many_splits(spark, place, longest):
    rng = random.Random(5)
    records = [f'{i},"{"".join(rng.choice(["a", ",", chr(10), chr(34) * 2, "é"]) for _ in range(rng.randrange(9)))}",z' for i in range(300)]
    path = place("quoted", "\n".join(records) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "301")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        assert spark.read.text(path).rdd.getNumPartitions() > 8
        found = readers.quoted_records(spark, path, longest).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    want = [r for r in records if r.count("\n") < longest]
    assert sorted(r.line for r in found if not r.open) == sorted(want)
    broken = sorted(x for r in records if r.count("\n") >= longest for x in r.split("\n"))
    assert sorted(r.line for r in found if r.open) == broken


def test_an_unclosed_quote_ends_with_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\n2,y\n')
    (tmp_path / "b.csv").write_text('3,"p\nq"\n4,r\n')
    found = {(r.line, r.open) for r in readers.quoted_records(spark, str(tmp_path)).collect()}
    assert found == {('1,"x\n2,y', True), ('3,"p\nq"', False), ("4,r", False)}


def test_labelled(spark, place):
    path = place("m", "p1,p2,Label\n0,1,1\n1,1,0\n1,oops,0\n1,,0\n")
    rows, rejects = readers.read_labelled(spark, path)
    got = rows.select(vector_to_array("features").alias("f"), "label").collect()
    assert sorted((tuple(r["f"]), r["label"]) for r in got) == [((0.0, 1.0), 1.0), ((1.0, 1.0), 0.0)]
    assert sorted(r[0] for r in rejects.collect()) == ["1,,0", "1,oops,0"]


def test_recommendation_lines(spark, place):
    recs = spark.createDataFrame([(2, []), (1, [5, 3])], "id long, recs array<long>")
    writers.write_recommendations(recs, place.out("r"), single=True)
    assert written(spark, place.out("r")) == ["1\t5,3", "2\t"]


def test_itemset_report(spark, place):
    tx = spark.createDataFrame([("x", "1"), ("x", "2"), ("y", "1"), ("y", "2")], "basket string, item string")
    names = spark.createDataFrame([("1", "one"), ("2", "two")], "item string, description string")
    report = baskets.itemset_report(baskets.frequent_itemsets(tx, 2), names)
    writers.write_itemset_report(report, place.out("i"))
    assert written(spark, place.out("i")) == [
        "=== Frequent Itemsets Analysis ===", "",
        "Count of frequent itemsets (size 1): 2",
        "Count of frequent itemsets (size 2): 1",
        "Count of frequent itemsets (size 3): 0", "",
        "Top 10 frequent itemsets of size 1:", "1 (one) -> support: 2", "2 (two) -> support: 2", "",
        "Top 10 frequent itemsets of size 2:", "1 (one), 2 (two) -> support: 2", "",
        "Top 10 frequent itemsets of size 3:",
    ]
    rules = baskets.rule_report(baskets.association_rules(baskets.frequent_itemsets(tx, 2), 2), names)
    writers.write_rule_report(rules, place.out("rules"), single=True)
    assert written(spark, place.out("rules"))[0] == "one -> two | SL: 0.0000, lift: 1.0000, conf: 1.0000, interest: 0.0000"


def test_predictions_csv(spark, place):
    top = spark.createDataFrame(
        [(1, 7, 'Say "hi", then', 2.00004), (1, 8, None, 10.0), (0, 9, "x", 1.0)],
        "user long, item long, title string, predicted double",
    )
    writers.write_predictions(top, place.out("p"), single=True)
    assert written(spark, place.out("p")) == [
        "UserID,MovieID,Movie Name,Predicted Rating", "0,9,x,1.0000", "1,8,,10.0000", '1,7,"Say ""hi"", then",2.0000',
    ]
    writers.write_csv(top.select("user", "item"), place.out("q"), ["item"], single=True)
    assert written(spark, place.out("q")) == ["user,item", "1,7", "1,8", "0,9"]


def test_stats_profile_and_log_reports(spark, place):
    rows = [(i, [float(i % 3) * 10 + 0.1 * (i % 5), 1.0 + 0.01 * (i % 7)]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    stats = summ.cluster_stats(
        df.withColumn("cluster", (F.col("id") % 3).cast("int")).withColumn("k", F.lit(3)), ["k", "cluster"]
    )
    writers.write_stats_report(summ.stats_report(stats), place.out("s"))
    lines = written(spark, place.out("s"))
    assert lines[:2] == ["", "=== Clustering with k = 3 ==="] and len(lines) == 5
    assert lines[2].startswith("Cluster 0: size=20, radius=0.14, diameter=")

    bfr, version = run_chunks(df, 30, BfrSettings(k=3, over=2, rows_per_task=30))
    clusters, assigned, retained = bfr.finish(version)
    writers.write_run_log(bfr.report(version), clusters, retained, place.out("log"), single=True)
    log = written(spark, place.out("log"))
    assert log[1] == "=== Initialization ===" and "--- Processing chunk 2 ---" in log and "=== FINAL REPORT ===" in log
    assert any(line.startswith("  Cluster 0: N=") for line in log)

    writers.write_assignments(assigned, place.out("map"))
    back = readers.read_assignments(spark, place.out("map"))
    assert back.count() == assigned.count()
    labels = spark.createDataFrame([(i, "Rock") for i in range(60)], "id long, label string")
    profile = prof.profile_clusters(prof.label_counts(back, labels))
    writers.write_profile_report(prof.profile_report(profile), place.out("prof"), single=True)
    assert written(spark, place.out("prof"))[0] == "Cluster 0:"


def test_study_table_round_trip(spark, place):
    df = spark.createDataFrame([("adaboost", 100, None, 0.1, 97.9)], "algo string, n_estimators int, max_depth int, learning_rate double, accuracy double")
    writers.write_study(df, place.out("study"))
    assert spark.read.parquet(place.out("study")).collect() == df.collect()

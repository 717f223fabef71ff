import pytest

from affinia.session import cut_lineage, scratch_path, shared_dir, store


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder + "/of-this-application"


class Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.settings = Context(master), conf
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_the_cluster_names_the_folder():
    session = Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared"})
    assert shared_dir(session) == "hdfs:///shared"
    assert session.sparkContext.folder.startswith("hdfs:///shared")


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_dir(Session("spark://host:7077"))


def test_a_local_session_gets_one_folder_of_its_own():
    session = Session("local[2]")
    first = shared_dir(session)
    assert shared_dir(session).startswith(first)


def test_store_and_cut_keep_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "array(id) AS a", "cast(null AS int) AS n")
    for kept in (store(df, "t"), cut_lineage(df)):
        assert kept.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))
    assert store(df.limit(0), "t").count() == 0
    assert scratch_path(spark, "x") != scratch_path(spark, "x")

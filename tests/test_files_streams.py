"""Files, incremental loads, streams and the whole chain."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from checks.frames import frame
from checks.q_matching import monthly_files
from paypanel.operators.schema import PANEL_COLUMNS, coalesce_repeated, repeated_columns
from paypanel.operators.sets import panel_order, sample_rows
from paypanel.operators.silver import drop_if_others_empty, rename_by_codes
from paypanel.plans.medallion import Layers, rebuild
from paypanel.plans.stages import written
from paypanel.sources import files
from paypanel.streaming import ingest


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="paypanel-test-")


def raw(spark):
    data = []
    for name, header in [("a", 0), ("b", 3), ("c", 19), ("d", 20), ("e", None)]:
        for i in range(25):
            cells = ["Matricule", "Nom"] if i == header else [f"{name}{i}", None if i % 2 else " "]
            data.append((name, i, cells))
    return spark.createDataFrame(data, files.RAW_SCHEMA)


def test_header_search(spark):
    got = {r["fichier"]: r["entete"] for r in files.locate_header(raw(spark)).collect()}
    assert got == {"a": 0, "b": 3, "c": 19, "d": 0, "e": 0}
    assert {r["entete"] for r in files.locate_header(raw(spark).where("fichier = 'e'"), default=1).collect()} == {1}


def test_header_score_needs_critical_and_half_of_important(spark):
    d = spark.createDataFrame(
        [("x", 0, ["Matricule", "a"]), ("x", 1, ["matricule", "Nom", "b"]), ("x", 2, ["MATRICULE", "Nom", "Sexe"]), ("y", 0, ["Nom", "Sexe"])],
        files.RAW_SCHEMA,
    )
    got = files.score_header(d, ["MATRICULE"], ["NOM", "SEXE"]).collect()
    assert [(r["fichier"], r["entete"], r["score"]) for r in got] == [("x", 2, 1.0)]


def test_apply_header_unites_layouts(spark):
    d = spark.createDataFrame(
        [("x", 0, ["Matricule", "Nom"]), ("x", 1, ["1", "n1"]), ("x", 2, [None, " "]), ("y", 0, ["Matricule", "Sexe", "Sexe"]), ("y", 1, ["2", "F", "G"])],
        files.RAW_SCHEMA,
    )
    out = files.apply_header(d, files.locate_header(d))
    assert sorted(out.columns) == ["MATRICULE", "NOM", "SEXE", "SEXE_2", "fichier", "ligne"]
    assert sorted((r["MATRICULE"], r["NOM"], r["SEXE"], r["SEXE_2"]) for r in out.collect()) == [("1", "n1", None, None), ("2", None, "F", "G")]


def test_many_layouts(spark):
    """10 000 files with four orders of the same names, one of them in two spellings."""
    f = F.col("id")
    names = F.array(F.lit("Matricule"), F.lit("montant-brut"), F.lit("Net"), F.lit("net"))
    file = spark.range(10_000).select(F.concat(F.lit("f"), f).alias("fichier"), "id")
    turned = F.concat(F.slice(names, (f % 4 + 1).cast("int"), F.lit(4)), F.slice(names, F.lit(1), (f % 4).cast("int")))
    head = file.select("fichier", F.lit(0).alias("ligne"), turned.alias("cellules"))
    values = F.transform(turned, lambda n: F.concat(n, F.lit("="), f))
    body = file.select("fichier", F.lit(1).alias("ligne"), values.alias("cellules"))
    raw = head.unionByName(body)
    out = files.apply_header(raw, files.locate_header(raw))
    assert sorted(out.columns) == ["MATRICULE", "MONTANT_BRUT", "NET", "NET_2", "fichier", "ligne"]
    assert out.count() == 10_000
    odd = out.where(~F.col("MATRICULE").startswith("Matricule=") | ~F.col("MONTANT_BRUT").startswith("montant-brut=") | F.col("NET").isNull())
    assert odd.count() == 0


def test_dynamic_overwrite_keeps_other_years(spark, folder):
    d = spark.createDataFrame([(2020, 1), (2021, 2), (2021, 3)], "annee int, v int")
    files.write_partitioned(d, folder + "/t")
    files.write_partitioned(spark.createDataFrame([(2021, 9)], "annee int, v int"), folder + "/t")
    assert sorted(map(tuple, spark.read.parquet(folder + "/t").select("annee", "v").collect())) == [(2020, 1), (2021, 9)]
    plan = files.read_silver(spark, folder + "/t", [2020], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2020" in plan and "ReadSchema: struct<v:int>" in plan


def test_bounded_parts(spark, folder):
    files.write_bounded_parts(spark.range(0, 25, 1, 1), folder + "/p", 10)
    assert sum(f.endswith(".parquet") for f in os.listdir(folder + "/p")) == 3


def test_append_takes_only_later_periods(spark):
    base = spark.createDataFrame([(202312, 1)], "periode int, a int")
    new = spark.createDataFrame([(202312, 5), (202401, 6)], "periode int, b int")
    assert sorted(map(tuple, files.append_new_periods(base, new).collect())) == [(202312, 1, None), (202401, None, 6)]
    assert files.append_new_periods(base.limit(0), new).count() == 2


def test_a_failed_publish_leaves_readers_on_the_old_version(spark, folder):
    base = folder + "/v"
    assert files.current_version(spark, base) is None
    with pytest.raises(FileNotFoundError):
        files.read_current(spark, base)
    assert files.publish_version(spark.range(3), base) == 1
    with pytest.raises(ValueError):
        files.publish_version(spark.range(9), base, check=lambda d: d.count() < 5)
    assert files.current_version(spark, base) == 1 and files.read_current(spark, base).count() == 3
    assert files.publish_version(spark.range(4), base) == 3  # the failed number is not used again
    assert files.read_current(spark, base).count() == 4
    assert os.path.isdir(base + "/version=1")  # the one before stays
    assert files.publish_version(files.read_current(spark, base).union(spark.range(1)), base) == 4
    assert sorted(n for n in os.listdir(base) if n.startswith("version=")) == ["version=3", "version=4"]
    assert files.read_current(spark, base).count() == 5


def test_reports_are_small(spark, folder):
    with pytest.raises(ValueError):
        files.write_report_csv(spark.range(11), folder + "/r", most=10)
    files.write_report_csv(spark.range(10), folder + "/r", most=10)


def test_sample_is_repeatable(spark):
    d = spark.range(1000).withColumnRenamed("id", "k")
    a, b = (sorted(r[0] for r in sample_rows(x, ["k"], 10).collect()) for x in (d, d.repartition(7)))
    assert a == b and len(a) == 10 and a != list(range(10))


def test_panel_order_is_sorted_inside_partitions(spark):
    d = spark.createDataFrame([(None, 1), ("b", 2), ("a", 3), ("a", 1)], "m string, y int")
    parts = panel_order(d, ["m", "y"]).withColumn("p", F.spark_partition_id()).collect()
    assert [tuple(r)[:2] for r in parts] == [("a", 1), ("a", 3), ("b", 2), (None, 1)]


def test_repeated_columns_and_labels(spark):
    assert repeated_columns(["Prime", "prime (2)", "PRIME_", "x"]) == {"prime": ["Prime", "prime (2)", "PRIME_"]}
    e = spark.createDataFrame([(1, 0.0, 2.0), (2, None, None)], "k int, `z 1 (a)` double, `z 1 (b)` double")
    assert [r["z 1"] for r in coalesce_repeated(e, zero_is_filled=False).orderBy("k").collect()] == [2.0, None]
    assert rename_by_codes(["k", "1", "2", "3"], {"1": "P", "2": "P", "3": "Q"}) == ["k", "P (code 1)", "P (code 2)", "Q"]


def test_drop_if_others_empty(spark):
    d = spark.createDataFrame([(1, None, None, " "), (2, "x", None, None), (3, "x", "y", None), (4, "x", "y", "z")], "i int, a string, b string, o string")
    assert sorted(r["i"] for r in drop_if_others_empty(d, ["a", "b"], ["i", "a", "b"]).collect()) == [2, 4]


def test_exactly_once_and_redelivery(spark, sf, folder):
    landing = monthly_files(spark, sf).replace("file:", "")
    schema = frame(spark, sf, "panel_src").drop("mois_annee", "periode").schema
    args = (spark, landing, schema, folder + "/eff", folder + "/ck")
    ingest.running_effectifs(*args)
    first = {tuple(r) for r in spark.read.parquet(folder + "/eff").select("periode", "organisme", "nb_lignes").collect()}
    # the January file arrives again, corrected to a single row
    one = spark.read.schema(schema).parquet(f"{landing}/011996.parquet").limit(1)
    one.coalesce(1).write.parquet(folder + "/fix")
    part = next(f for f in os.listdir(folder + "/fix") if f.endswith(".parquet"))
    os.rename(f"{folder}/fix/{part}", f"{landing}/011996_v2.parquet")
    ingest.running_effectifs(*args)
    second = {tuple(r) for r in spark.read.parquet(folder + "/eff").select("periode", "organisme", "nb_lignes").collect()}
    january = [r for r in second if r[0] == 199601]
    assert len(january) == 1 and january[0][2] == 1
    assert {r for r in first if r[0] != 199601} == {r for r in second if r[0] != 199601}


def test_split_and_late_deliveries(spark, sf, folder):
    landing = folder + "/landing"
    os.makedirs(landing)
    schema = frame(spark, sf, "panel_src").drop("mois_annee", "periode").schema
    rows = spark.read.schema(schema).parquet(monthly_files(spark, sf) + "/011996.parquet").limit(5).collect()
    args = (spark, landing, schema, folder + "/eff", folder + "/ck")

    def land(name, part):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        file = next(f for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet"))
        os.rename(f"{folder}/{name}/{file}", f"{landing}/{name}.parquet")

    def counted():
        return sum(r["nb_lignes"] for r in spark.read.parquet(folder + "/eff").where("periode = 199601").collect())

    land("011996_a", rows[:2])
    land("011996_b", rows[2:3])
    ingest.running_effectifs(*args)
    assert counted() == 3  # both halves of one delivery
    land("011996_c", rows[3:4])
    ingest.running_effectifs(*args)
    assert counted() == 4  # a part that arrives later
    land("011996_v3", rows[:2])
    ingest.running_effectifs(*args)
    assert counted() == 2
    land("011996_v2", rows)
    ingest.running_effectifs(*args)
    assert counted() == 2  # an older delivery that arrives late
    ingest.running_effectifs(*args)
    assert counted() == 2  # nothing new


def test_renamed_redeliveries(spark, sf, folder):
    landing = folder + "/landing"
    os.makedirs(landing)
    schema = frame(spark, sf, "panel_src").drop("mois_annee", "periode").schema
    source = spark.read.schema(schema).parquet(monthly_files(spark, sf) + "/011996.parquet").where("sexe is not null")
    rows = source.limit(6).collect()
    args = (spark, landing, schema, folder + "/eff", folder + "/ck")

    def land(name, part, at):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        file = next(f for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet"))
        os.utime(f"{folder}/{name}/{file}", (at, at))
        os.rename(f"{folder}/{name}/{file}", f"{landing}/{name}.parquet")

    def counted():
        got = spark.read.parquet(folder + "/eff").where("periode = 199601").collect()
        return sum(r["nb_lignes"] for r in got), sum(r["nb_agents"] for r in got)

    def agents(part):
        return len({(r["organisme"], r["matricule"]) for r in part if r["matricule"] is not None})

    land("011996", rows[:3], 1_000_000)
    ingest.running_effectifs(*args)
    assert counted() == (3, agents(rows[:3]))
    land("011996_corrige", rows[:2], 2_000_000)
    ingest.running_effectifs(*args)
    assert counted() == (2, agents(rows[:2]))  # replaces, is not added
    land("011996_corrige_part2", rows[4:5], 3_000_000)
    land("011996_b", rows, 3_100_000)
    ingest.running_effectifs(*args)
    assert counted() == (3, agents(rows[:2] + rows[4:5]))  # a part of the newer one counts, one of the older does not
    land("021996", rows[:1], 3_200_000)
    ingest.running_effectifs(*args)
    assert counted()[0] == 3
    land("011996-rectifie", rows[:1], 4_000_000)
    ingest.running_effectifs(*args)
    assert counted() == (1, agents(rows[:1]))


def test_written_cuts_the_plan(spark):
    d = written(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in d._jdf.queryExecution().optimizedPlan().toString() and d.count() == 5


def test_whole_chain(spark, sf, folder):
    bronze = frame(spark, sf, "panel_src")
    dims = {
        "CODE_ORGANISME": (frame(spark, sf, "dim_organisme"), "organisme", []),
        "CODE_EMPLOI": (frame(spark, sf, "dim_emploi"), "emploi", ["Code_CITP", "Metier_CITP"]),
    }
    out = rebuild(spark, bronze, dims, Layers(folder, "1"))
    kept = out["silver"].count()
    assert kept == bronze.count() - bronze.where("situation is null or situation = 'Retraite'").count()
    assert sorted(out["panel"].columns) == sorted(PANEL_COLUMNS)
    assert out["panel"].groupBy("matricule", "mois_annee").count().where("count > 1").count() == 0
    assert out["masse_salariale"].agg(F.sum("nb_lignes")).first()[0] == kept
    assert out["effectifs"].agg(F.sum("nb_lignes")).first()[0] == kept
    assert out["silver"].where("montant_brut_SOURCE <> 'NON_IMPUTABLE' and montant_brut is null").count() == 0

"""Tables stored as dealt: fits read them where they lie, and a second model's inputs are joined once."""

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wayfold.learn import classifiers, cross_validation, decompose, stacking
from wayfold.operators import folds
from wayfold.session import cut_lineage


def _rows(spark, n=300):
    return spark.range(n).select(F.col("id").alias("sid"), (F.col("id") % 7).cast("double").alias("a"), F.rand(1).alias("b"),
                                 (F.col("id") % 3).cast("int").alias("click_mode"))


def test_a_fold_of_a_stored_table_lies_as_if_dealt_on_its_own(spark):
    stored = cut_lineage(cross_validation.dealt(folds.folds_shuffled(_rows(spark), 2), "sid"))
    train = stored.where("fold = 1")
    place = lambda df: [tuple(r) for r in df.select(F.spark_partition_id(), "sid").collect()]
    assert place(train) == place(cross_validation.dealt(train, "sid"))
    seen = [sorted(cross_validation.cv_classifier(stored, ["a", "b"], classifiers.forest(3, 3), laid=laid).collect()) for laid in (True, False)]
    assert seen[0] == seen[1]


def test_folds_by_a_basis_are_those_of_the_table(spark):
    df = _rows(spark)
    plain, by = (sorted(folds.folds_shuffled(df, 3, basis=b).select("sid", "fold").collect()) for b in (None, df.select("sid")))
    assert plain == by


def test_inputs_of_a_second_model_are_computed_once(spark):
    met = spark.sparkContext.accumulator(0)

    def seen(x):
        met.add(1)
        return x
    stacked = _rows(spark).withColumn("prob_0", F.udf(seen, "double").asNondeterministic()(F.col("b"))).select("sid", "click_mode", "prob_0")
    table = cut_lineage(folds.folds_shuffled(_rows(spark), 2))
    done = stacking.stack_fit(stacked, table, classifiers.logistic(rounds=3), scaled=True)
    assert done.count() == 300
    done.agg(F.sum("prob_1")).collect()
    assert met.value == 300


def test_stacked_rows_of_the_final_model_are_computed_once(spark, tmp_path):
    met = spark.sparkContext.accumulator(0)

    def seen(x):
        met.add(1)
        return x
    rows = _rows(spark).withColumn("prob_1", F.lit(0.5))
    stacked = rows.withColumn("prob_0", F.udf(seen, "double").asNondeterministic()(F.col("b"))).select("sid", "click_mode", "prob_0", "prob_1")
    unseen = rows.select("sid", F.col("b").alias("prob_0"), "prob_1")
    done = stacking.stack_final(stacked, unseen, classifiers.logistic(rounds=3), str(tmp_path / "model"))
    assert done.count() == 300 and met.value == 300


def test_stored_vectors_give_the_models_of_their_columns(spark, tmp_path):
    stored = cut_lineage(cross_validation.dealt(folds.split_random(folds.folds_shuffled(_rows(spark), 2)), "sid"))
    packed = cut_lineage(cross_validation.dealt(decompose.assemble(stored, ["a", "b"]).drop("a", "b"), "sid"))
    seen = []
    for table, vector in ((stored, None), (packed, "features")):
        train, test = table.where("split = 'train'"), table.where("split = 'test'")
        oof = cross_validation.cv_classifier(table, ["a", "b"], classifiers.tree(3), laid=True, vector=vector)
        new = cross_validation.final_fit_predict(train, test, ["a", "b"], classifiers.tree(3), str(tmp_path / f"m{len(seen)}"), laid=True, vector=vector)
        seen.append((sorted(oof.collect()), sorted(new.collect())))
    assert seen[0] == seen[1]
    model = PipelineModel.load(str(tmp_path / "m1"))
    assert model.transform(stored.select("sid", "a", "b")).count() == 300


def test_cuts_by_a_basis_read_stored_digests(spark):
    met = spark.sparkContext.accumulator(0)

    def seen(x):
        met.add(1)
        return x
    basis = spark.range(300).select(F.udf(seen, "long").asNondeterministic()("id").alias("sid"))
    folds.folds_shuffled(_rows(spark), 3, basis=basis)
    assert met.value == 300


def test_vectors_spread_into_their_columns(spark):
    rows = _rows(spark, 40).withColumn("a", F.when(F.col("sid") % 11 != 0, F.col("a"))).select("sid", "a", "b")
    back = decompose.spread(decompose.assemble(rows, ["a", "b"]).drop("a", "b"), ["a", "b"]).select("sid", "a", "b")
    missing = F.lit(float("nan"))
    assert back.where(F.isnan("a")).count() == 4
    assert back.exceptAll(rows.withColumn("a", F.coalesce("a", missing))).count() == 0 and back.count() == 40

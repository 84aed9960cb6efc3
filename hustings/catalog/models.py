"""Model fitting, validation and whole workflows; few trees, all rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hustings.catalog import query, table
from hustings.catalog.grids import ORDER_ROWS, customer_pages, order_grid, texts
from hustings.operators import models
from hustings.operators.encoding import encode_closed
from hustings.operators.ordering import balanced_folds
from hustings.operators.skew import lookup
from hustings.operators.winners import pick_winners
from hustings.plans import history, template, web
from hustings.session import dealt, fresh_path, materialise
from hustings.sources.grids import union_sources

SMALL = {"maxIter": 3, "maxDepth": 4}
FITS = 5
LINE = ["l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
DOC_FEATURES = ["state_code", "party_code", "n_chars", "is_major_party"]


def document_rows(spark: SparkSession, sf_dir: str, lang: str | None = None) -> DataFrame:
    """Labelled documents, or those of one language, as training rows with folds: language is the state, source the party."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labelled = (
        table(spark, sf_dir, "labels")
        .join(documents if lang is None else documents.where(F.col("lang") == lang), "doc_id")
        .withColumn("is_major_party", (F.col("source") == "src1").cast("int"))
    )
    coded = encode_closed(labelled, {"lang": "state_code", "source": "party_code"}, ["doc_id"])
    folded = balanced_folds(coded, ["quality"], ["doc_id"])
    return models.training_rows(folded, DOC_FEATURES, "quality", ["doc_id"], partitions=4)


@query("m5_predict_one_winner", "select l_orderkey, 1::bigint as n from lineitem group by 1")
def predict_one_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees fitted on all line items, exactly one predicted winner per order."""
    lines = table(spark, sf_dir, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    features = ["l_quantity", "l_discount", "l_tax"]
    rows = models.training_rows(lines, features, "label", ["l_orderkey", *LINE])
    scored = models.score(models.fit(rows, models.boosted_trees("template", **SMALL)), rows)
    scored = materialise(scored.select("l_orderkey", *LINE, "p_win"))
    picked = pick_winners(scored, ["l_orderkey"], "p_win", LINE)
    return picked.where(F.col("outcome") == "W").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


_LABELLED = "select doc_id, lang, quality from labels join documents using (doc_id) where quality is not null"


@query(
    "m8_cv_accuracy",
    f"""with r as ({_LABELLED}), c as (select quality, count(*) as n from r group by 1),
    f as (select unnest(range(5)) as fold)
    select cast(fold as varchar) as fold, cast(sum((n + 4 - fold) // 5) as bigint) as n_rows, true as fits from c, f group by fold
    union all select 'mean', 5, true""",
)
def cv_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every fold, and whether the accuracies lie in range and their mean is the mean of the folds."""
    rows = document_rows(spark, sf_dir)
    scored = models.cross_validate(rows, lambda: models.boosted_trees("history", "quality", **SMALL), parallelism=FITS)
    per_fold = materialise(models.fold_accuracy(scored, "quality"))
    mean = models.mean_accuracy(per_fold).withColumn("again", per_fold.agg(F.sum("accuracy") / 5).scalar())
    fits = F.col("accuracy").between(0, 1)
    return per_fold.select(F.col("fold").cast("string").alias("fold"), "n_rows", fits.alias("fits")).unionByName(
        mean.select(
            F.lit("mean").alias("fold"), F.col("n_folds").alias("n_rows"), (F.abs(F.col("mean_accuracy") - F.col("again")) < 1e-9).alias("fits")
        )
    )


@query("m7_split_counts", f"select unnest({DOC_FEATURES}) as feature, true as whole, true as any_split")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All features once, each with as many splits as the trees' printed form has, and a split over all of them."""
    rows = document_rows(spark, sf_dir)
    model = models.fit(rows, models.boosted_trees("web", "quality", **SMALL))
    counts = materialise(models.split_counts(model, spark, DOC_FEATURES))
    total = counts.agg(F.sum("n_splits")).scalar()
    printed = F.lit(0)
    for i, feature in enumerate(DOC_FEATURES):
        printed = F.when(F.col("feature") == feature, model.toDebugString.count(f"If (feature {i} ")).otherwise(printed)
    return counts.select("feature", (F.col("n_splits") == printed).alias("whole"), (total > 0).alias("any_split"))


@query(
    "m12_model_comparison",
    """select unnest(['boosted trees', 'random forest', 'logistic regression']) as model, true as in_range, true as learned""",
)
def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every classifier once, its accuracy that of Spark's own cross-validator and above a coin's."""
    rows = document_rows(spark, sf_dir)
    rivals = models.rival_models("quality", trees=5, logistic_steps=20, maxIter=2, maxDepth=3)
    found = models.compare_models(rows, rivals, "quality", parallelism=FITS)
    own = [models.select_model(rows, make(), [{}], "quality", parallelism=FITS)[1].withColumn("model", F.lit(n)) for n, make in rivals.items()]
    both = found.join(union_sources(own).select("model", F.col("mean_accuracy").alias("_own")), "model")
    same = F.abs(F.col("mean_accuracy") - F.col("_own")) < 1e-9
    return both.select("model", same.alias("in_range"), (F.col("mean_accuracy") > 0.5).alias("learned"))


@query(
    "m13_state_tuning",
    """select 'maxIter=2, stepSize=' || s || ', maxDepth=' || d as settings, true as in_range
    from (select unnest(['0.05', '0.1']) as s), (select unnest(['2', '4']) as d)""",
)
def state_tuning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learning rate and depth tried on one state, picked before anything is encoded; the means are those of Spark's own
    cross-validator."""
    rows = document_rows(spark, sf_dir, "en")
    grid = [{"maxIter": 2, "stepSize": s, "maxDepth": d} for s in (0.05, 0.1) for d in (2, 4)]
    found = models.tune(rows, grid, "quality", parallelism=FITS)
    _, own = models.select_model(rows, models.boosted_trees("history", "quality"), grid, "quality", parallelism=FITS)
    both = found.join(own.select("settings", F.col("mean_accuracy").alias("_own")), "settings")
    return both.select("settings", (F.abs(F.col("mean_accuracy") - F.col("_own")) < 1e-9).alias("in_range"))


@query(
    "m14_pr",
    f"""select lang, avg(quality) as precision_of_all, case when sum(quality) > 0 then 1.0::double end as recall_of_all,
      true as falling from ({_LABELLED}) group by 1""",
)
def precision_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall when everything is taken, and whether recall only falls with the threshold."""
    rows = document_rows(spark, sf_dir)
    scored = models.cross_validate(rows, lambda: models.boosted_trees("history", "quality", **SMALL), parallelism=FITS)
    curve = models.precision_recall(scored, ["lang"], "quality")
    recalls = F.transform(F.array_sort(F.collect_list(F.struct("threshold", "recall"))), lambda p: F.coalesce(p["recall"], F.lit(0.0)))
    falling = recalls == F.reverse(F.array_sort(recalls))
    return curve.groupBy("lang").agg(
        F.min_by("precision", "threshold").alias("precision_of_all"), F.min_by("recall", "threshold").alias("recall_of_all"), falling.alias("falling")
    )


@query(
    "m13_model_selection",
    f"""with s as (select 'stepSize=' || s || ', maxDepth=' || d as settings from (select unnest(['0.05', '0.1']) as s), (select unnest(['2', '4']) as d)),
    n as (select count(*) as n from ({_LABELLED}) where lang = 'en')
    select settings, true as agrees, n as n_scored from s, n union all select 'chosen: 1', true, n from n""",
)
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings tried on one state with Spark's cross-validator.  ``agrees``: mean and deviation are those of folds fitted and
    counted one by one; in the last row: the chosen setting has the highest mean and is the one that is returned."""
    rows = document_rows(spark, sf_dir, "en")
    grid = models.parameter_grid(stepSize=[0.05, 0.1], maxDepth=[2, 4])
    trees = models.boosted_trees("history", "quality", maxIter=2)
    best, found = models.select_model(rows, trees, grid, "quality", parallelism=FITS)
    found = materialise(found)
    checks = []
    for changes in grid:
        scored = models.cross_validate(rows, lambda c=changes: models.boosted_trees("history", "quality", maxIter=2, **c), parallelism=FITS)
        folds = models.fold_accuracy(scored, "quality")
        name = ", ".join(f"{k}={v}" for k, v in changes.items())
        checks.append(folds.agg(F.avg("accuracy").alias("_mean"), F.stddev_pop("accuracy").alias("_dev")).withColumn("settings", F.lit(name)))
    scored = models.score(best, rows).agg(F.count_if(F.col("p_win").between(0, 1)).alias("n_scored"))
    near = (F.abs(F.col("mean_accuracy") - F.col("_mean")) < 1e-9) & (F.abs(F.col("deviation") - F.col("_dev")) < 1e-9)
    each = found.join(union_sources(checks), "settings").select("settings", near.alias("agrees"))
    kept = F.lit(f"stepSize={best.getOrDefault('stepSize')}, maxDepth={best.getOrDefault('maxDepth')}")
    chosen = found.agg(
        F.concat(F.lit("chosen: "), F.count_if("chosen").cast("string")).alias("settings"),
        ((F.max("mean_accuracy") == F.max(F.when(F.col("chosen"), F.col("mean_accuracy")))) & (F.max(F.when(F.col("chosen"), F.col("settings"))) == kept)).alias("agrees"),
    )
    return each.unionByName(chosen).join(F.broadcast(scored))


@query(
    "m14_pr_area",
    """with p as (select l_linestatus, l_returnflag, round(l_discount + l_tax, 4) as threshold, count(*) as n,
        count(*) filter (l_quantity > 25 and l_returnflag <> 'N') as hits
      from lineitem where l_discount <> 0.05 group by all),
    s as (select *, sum(hits) over w as hits_above, sum(n) over w as n_above, sum(hits) over (partition by l_linestatus, l_returnflag) as all_hits
      from p window w as (partition by l_linestatus, l_returnflag order by threshold desc))
    select l_linestatus, l_returnflag, cast(sum(n) as bigint) as n_rows, cast(sum(hits) as bigint) as n_hits,
      round(sum(case when all_hits > 0 then hits_above::double / n_above::double * (hits::double / all_hits::double) end), 9) as area
    from s group by all""",
)
def pr_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact average precision of a given score; groups of line items as states, one of them without a hit."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_linestatus",
        "l_returnflag",
        F.when(F.col("l_discount") != 0.05, F.round(F.col("l_discount") + F.col("l_tax"), 4)).alias("score"),
        ((F.col("l_quantity") > 25) & (F.col("l_returnflag") != "N")).cast("int").alias("label"),
    )
    area = models.precision_recall_area(lines, ["l_linestatus", "l_returnflag"], "label", "score")
    return area.withColumn("area", F.round("area", 9))


@query(
    "m14_pr_points",
    """with p as (select n_nationkey as state, l_extendedprice as threshold, count(*) as n, count(*) filter (l_returnflag = 'R') as hits
      from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by all)
    select state, threshold, n, hits, sum(hits) over w / cast(sum(n) over w as double) as precision,
      sum(hits) over w / cast(nullif(sum(hits) over (partition by state), 0) as double) as recall
    from p window w as (partition by state order by threshold desc)""",
)
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall at every price, suppliers' nations as states."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_returnflag")
    nations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("state"))
    scored = lookup(lines, nations, ["l_suppkey"], ["l_extendedprice"], "inner").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return models.precision_recall_points(scored, ["state"], "label", "l_extendedprice").drop("all_hits")


@query(
    "e1_outcomes",
    f"""with r as ({ORDER_ROWS}), k as (
      select source, constituency_no, tidy_state from r where source not in ('source 3', 'source 4')
        and candidate is not null and total_votes_raw is not null
        and upper(candidate) not in ('NOTA', 'NONE OF THE ABOVE'))
    select source, constituency_no, count(*) as n_rows, 1::bigint as n_wins from k group by 1, 2""",
)
def history_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole history workflow, one WIN per contest."""
    rows = history.training_table(history.labelled_results(order_grid(spark, sf_dir)))
    _, predicted = history.outcomes(rows, mode="argmax", **SMALL)
    return predicted.groupBy("source", "constituency_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("outcome") == "WIN").alias("n_wins")
    )


_TEMPLATE_WINNERS = """select 'sheet ' || cast(c_nationkey % 5 as varchar) as sheet, 'AC ' || cast(c_nationkey as varchar) as constituency,
    count(*) as n_rows, 1::bigint as n_winners from customer group by 1, 2"""


@query("e2_template_outcomes", _TEMPLATE_WINNERS)
def template_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole template workflow: history from the orders, template rows from the customers, five sheets."""
    return winners_of_the_template(spark, sf_dir, **SMALL)


@query("e2_full_preset", _TEMPLATE_WINNERS)
def full_preset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The template workflow with the whole published preset: 150 trees of depth 5."""
    return winners_of_the_template(spark, sf_dir)


def winners_of_the_template(spark: SparkSession, sf_dir: str, **changes: object) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name", "c_mktsegment")
    sheet = [F.concat(F.lit(f"{of} "), (F.col("c_nationkey") % 5).cast("string")).alias(c) for c, of in (("source", "book"), ("sheet", "sheet"))]
    body = dealt(customers).select(
        *sheet,
        (F.col("c_custkey") + 1).alias("row_idx"),
        F.array(
            F.lit("Tamil-NADU"), F.concat(F.lit("AC "), F.col("c_nationkey").cast("string")), F.col("c_name"), F.col("c_mktsegment")
        ).alias("cells"),
    )
    heads = customers.select(*sheet).distinct().select(
        "*", F.lit(0).cast("bigint").alias("row_idx"), texts("State/UT", "Constituency", "Candidate", "Party").alias("cells")
    )
    grid = materialise(union_sources([body, heads]))
    sheets = [f"sheet {i}" for i in range(5)] + ["Absent"]
    future = template.template_records(grid, sheets)
    predicted = template.predict_template(history.labelled_results(order_grid(spark, sf_dir)), future, **changes)
    filled = template.filled_template(grid, predicted)
    body_rows = filled.where(F.col("row_idx") > 0)
    return body_rows.groupBy("sheet", F.get("cells", F.lit(1)).alias("constituency")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.get("cells", F.lit(5)) == "W").alias("n_winners")
    )


@query(
    "e3_web_outcomes",
    """with c as (select 's' || replace(cast(c_custkey as varchar) || '2021', '2021', '') as state,
        'AC ' || cast(c_nationkey as varchar) as constituency from customer where c_mktsegment <> 'MACHINERY')
    select state, constituency, 2 * count(*) as n_rows, 1::bigint as n_wins from c group by 1, 2""",
)
def web_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole web workflow: every table row of every page gets an outcome, one WIN per state and constituency."""
    rows = web.training_table(web.candidates_from_pages(customer_pages(spark, sf_dir)))
    predicted = web.outcomes(rows, mode="argmax", **SMALL)
    return predicted.groupBy("state", "constituency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("outcome") == "WIN").alias("n_wins")
    )


@query(
    "m10_kept_pipeline",
    """with c as (select 's' || replace(cast(c_custkey as varchar) || '2021', '2021', '') as state,
        'AC ' || cast(c_nationkey as varchar) as constituency from customer where c_mktsegment <> 'MACHINERY')
    select state, constituency, 2 * count(*) as n_rows, 1::bigint as n_wins, 2 * count(*) as n_same from c group by 1, 2""",
)
def kept_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The web workflow as one saved and reloaded pipeline; ``n_same`` rows have the score and outcome of the direct run."""
    candidates = materialise(web.candidates_from_pages(customer_pages(spark, sf_dir)))
    path = fresh_path(spark, "pipeline")
    web.fit_pipeline(candidates, "argmax", **SMALL).save(path)
    kept = PipelineModel.load(path).transform(candidates)
    direct = web.outcomes(web.training_table(candidates), mode="argmax", **SMALL)
    same = direct.select(*web.ROW, F.col("outcome").alias("_outcome"), F.col("p_win").alias("_p"))
    both = kept.join(same, web.ROW)
    agrees = (F.col("outcome") == F.col("_outcome")) & (F.col("p_win") == F.col("_p"))
    return both.groupBy("state", "constituency").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("outcome") == "WIN").alias("n_wins"), F.count_if(agrees).alias("n_same")
    )

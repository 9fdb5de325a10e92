"""End-to-end jobs over the raw delimited exports.

These are the jobs a user of the source scripts runs, re-expressed over the
library's operators (stage outputs that several branches read are written
under ``spark.checkpoint.dir``):

* ``feature_job``: impression TSV (``uid, urlid, ts, label`` with 2-character
  id prefixes) + page TSV (10 fields, optionally GBK) -> nine-column feature
  table (CSV or Parquet).
* ``text_job``: page TSV -> tokens -> stop words removed -> Word2Vec
  vectors and per-page mean vectors.
* ``model_job``: feature table -> logistic regression with the best-F
  threshold set on the model, held-out AUC, saved model.

Malformed lines are not dropped silently: they are written to a
``_quarantine`` folder next to the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlab import constants as C
from feedlab.functions.strings import clean_field, split_all, strip_prefix
from feedlab.operators.clean import guard_width
from feedlab.operators.features import FEATURE_COLUMNS, VECTOR_ORDER, assemble, train_feature
from feedlab.operators.terms import page_vector
from feedlab.operators.text import keywords
from feedlab.plans.stages import Stages
from feedlab.session import materialize, stage_outputs_removed
from feedlab.sources.readers import read_lines

PAGE_FIELDS = C.RAW_PAGE_FIELDS
IMPRESSION_FIELDS = C.RAW_IMPRESSION_FIELDS


def read_impression_export(spark: SparkSession, path: str, quarantine: str | None = None,
                           prefix_len: int = C.ID_PREFIX_LEN) -> DataFrame:
    """``uid \\t urlid \\t ts \\t label`` lines with prefixed ids -> typed impressions.

    Lines of the wrong width, or whose label or ids are not integers, go to
    ``quarantine`` (the source jobs would fail on them)."""
    good, bad = guard_width(read_lines(spark, path), len(IMPRESSION_FIELDS))
    f = split_all("value", "\t")
    label = F.get(f, F.lit(3)).try_cast("int")
    uid = strip_prefix(F.get(f, F.lit(0)), prefix_len).try_cast("bigint")
    urlid = strip_prefix(F.get(f, F.lit(1)), prefix_len).try_cast("bigint")
    whole = label.isNotNull() & uid.isNotNull() & urlid.isNotNull()
    if quarantine:
        bad.unionByName(good.where(~whole)).write.mode("overwrite").text(quarantine)
    return good.where(whole).select(uid.alias("uid"), urlid.alias("urlid"), F.get(f, F.lit(2)).alias("ts"),
                                    label.alias("label"))


def read_page_export(spark: SparkSession, path: str, charset: str | None = None,
                     quarantine: str | None = None, prefix_len: int = C.ID_PREFIX_LEN) -> DataFrame:
    """10-field page lines -> cleaned, typed page rows (fields trimmed, empty -> ``"-"``).

    Lines of the wrong width, or whose id is not an integer, go to ``quarantine``."""
    good, bad = guard_width(read_lines(spark, path, charset), len(PAGE_FIELDS))
    f = F.transform(split_all("value", "\t"), lambda x: clean_field(x))
    cols = {n: F.get(f, F.lit(i)) for i, n in enumerate(PAGE_FIELDS)}
    urlid = strip_prefix(cols["urlid"], prefix_len).try_cast("bigint")
    if quarantine:
        bad.unionByName(good.where(urlid.isNull())).write.mode("overwrite").text(quarantine)
    return good.where(urlid.isNotNull()).select(
        urlid.alias("urlid"),
        cols["utype"].alias("utype"), cols["url"].alias("url"), cols["title"].alias("title"),
        cols["pnum"].try_cast("int").alias("pnum"), cols["pdef"].try_cast("double").alias("pdef"),
        cols["pbeau"].try_cast("double").alias("pbeau"),
        cols["ppoint"].alias("points"), cols["tpoint"].alias("tags"), cols["tcontent"].alias("content"))


def feature_job(spark: SparkSession, impressions_path: str, pages_path: str, out_path: str,
                fmt: str = "csv", charset: str | None = None, title_k: int = C.TITLE_KEYWORDS, top_n: int = C.PROFILE_TOP_N,
                stages: Stages | None = None) -> DataFrame:
    """Impression and page exports -> the nine-column feature table at ``out_path``.

    With ``stages`` every stage is committed in its folder, and a job run again
    goes on after the last committed one (``Stages``)."""
    if stages is not None:
        feats = _staged_features(stages, impressions_path, pages_path, out_path, charset, title_k, top_n)
        feats.write.mode("overwrite").format(fmt).save(out_path)
        return spark.read.format(fmt).schema(feats.schema).load(out_path)
    imp = read_impression_export(spark, impressions_path, quarantine=f"{out_path}_quarantine/impressions")
    pages = read_page_export(spark, pages_path, charset, quarantine=f"{out_path}_quarantine/pages")
    pages = materialize(pages, "pages_clean")
    kw = keywords(pages.select("urlid", "title"), "urlid", "title", title_k).select("urlid", "term", "weight")
    pv = page_vector(kw, pages.select("urlid", "points", "tags"))
    feats = train_feature(imp, pages.select("urlid", "pnum", "pdef", "pbeau"), pv, top_n)
    feats.select(*FEATURE_COLUMNS).write.mode("overwrite").format(fmt).save(out_path)
    return spark.read.format(fmt).schema(feats.select(*FEATURE_COLUMNS).schema).load(out_path)


def _staged_features(stages: Stages, impressions_path: str, pages_path: str, out_path: str, charset: str | None,
                     title_k: int, top_n: int) -> DataFrame:
    """The stages of ``feature_job``; each output is read from its committed folder."""
    spark = stages.spark
    pages = stages.run("pages", lambda: read_page_export(spark, pages_path, charset, f"{out_path}_quarantine/pages"),
                       [pages_path], charset=charset, quarantine=out_path)
    kw = stages.run("title_keywords", lambda: keywords(pages.df.select("urlid", "title"), "urlid", "title", title_k)
                    .select("urlid", "term", "weight"), [pages], title_k=title_k)
    pv = stages.run("page_vector", lambda: page_vector(kw.df, pages.df.select("urlid", "points", "tags")), [kw, pages])
    imp = stages.run("impressions", lambda: read_impression_export(
        spark, impressions_path, f"{out_path}_quarantine/impressions"), [impressions_path], quarantine=out_path)
    attrs = pages.df.select("urlid", "pnum", "pdef", "pbeau")
    feats = stages.run("features", lambda: train_feature(imp.df, attrs, pv.df, top_n).select(*FEATURE_COLUMNS),
                       [imp, pages, pv], top_n=top_n)
    return feats.df


def text_job(spark: SparkSession, pages_path: str, out_path: str, charset: str | None = None,
             vector_size: int = 128, min_count: int = 2, truncate: int | None = None) -> DataFrame:
    """Page export -> stop-word-free tokens -> Word2Vec; writes ``words`` and
    ``pages`` (mean vectors) under ``out_path``."""
    from feedlab.functions.terms import truncate_tokens
    from feedlab.functions.tokens import tokenize
    from feedlab.operators.embed import fit_word2vec
    from feedlab.operators.text import remove_stopwords
    pages = read_page_export(spark, pages_path, charset, quarantine=f"{out_path}_quarantine/pages")
    toks = pages.select("urlid", "title",
                        F.concat(tokenize(F.col("title")), tokenize(F.col("content"))).alias("s_term"))
    filt = remove_stopwords(toks, "s_term", "tokens").drop("s_term")
    if truncate:
        filt = filt.withColumn("tokens", truncate_tokens("tokens", truncate))
    filt = materialize(filt, "w2v_tokens")
    model = fit_word2vec(filt, "tokens", vector_size, min_count)
    model.getVectors().write.mode("overwrite").parquet(f"{out_path}/words")
    model.transform(filt).select("urlid", "title", "result").write.mode("overwrite").parquet(f"{out_path}/pages")
    return spark.read.parquet(f"{out_path}/pages")


def model_job(spark: SparkSession, features: DataFrame, out_path: str, max_iter: int = 30, reg: float = 0.3,
              enet: float = 0.1, train_share: float = C.TRAIN_SPLIT_CLASSIFIER[0], seed: int = 42) -> DataFrame:
    """Feature table -> LR with the best-F threshold set on the model; saves the
    model and returns ``(metric, value)`` rows (held-out AUC ROC/PR, threshold)."""
    from pyspark.ml.functions import vector_to_array
    from feedlab.operators.evaluate import auc_pr, auc_roc, best_threshold
    from feedlab.operators.models import fit_lr, save_model
    data = materialize(assemble(features, VECTOR_ORDER), "model_input")
    train, test = data.randomSplit([train_share, 1 - train_share], seed)
    model = fit_lr(train, max_iter, reg, enet)
    curve = model.summary.fMeasureByThreshold.withColumnRenamed("F-Measure", "f_measure")
    t = float(best_threshold(curve, "f_measure").first()["threshold"])
    model.setThreshold(t)
    save_model(model, f"{out_path}/model")
    scored = model.transform(test).select("label", vector_to_array("probability")[1].alias("score"))
    scored = materialize(scored, "model_scores")
    rows = [("best_threshold", t),
            ("auc_roc", float(auc_roc(scored).first()["auc_roc"])),
            ("auc_pr", float(auc_pr(scored).first()["auc_pr"]))]
    return spark.createDataFrame(rows, "metric string, value double")


def main(argv: list[str] | None = None) -> None:
    """Command line for the jobs (``spark-submit -m`` style)::

        python -m feedlab.plans.jobs features --impressions IMP --pages PAGES --out OUT [--fmt csv] [--charset GBK] [--stages DIR]
        python -m feedlab.plans.jobs text --pages PAGES --out OUT [--size 128] [--min-count 2]

    The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
    settings (master, ``spark.checkpoint.dir``) are taken from the submission.
    """
    import argparse
    ap = argparse.ArgumentParser(prog="feedlab.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    f = sub.add_parser("features")
    f.add_argument("--impressions", required=True)
    f.add_argument("--pages", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--fmt", default="csv")
    f.add_argument("--charset", default=None)
    f.add_argument("--stages", default=None, help="folder of committed stage outputs: a job run again goes on from them")
    t = sub.add_parser("text")
    t.add_argument("--pages", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--charset", default=None)
    t.add_argument("--size", type=int, default=C.W2V_SIZE)
    t.add_argument("--min-count", type=int, default=C.W2V_MIN_COUNT)
    args = ap.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    with stage_outputs_removed(spark):
        if args.job == "features":
            feature_job(spark, args.impressions, args.pages, args.out, fmt=args.fmt, charset=args.charset,
                        stages=Stages(spark, args.stages) if args.stages else None)
        else:
            text_job(spark, args.pages, args.out, charset=args.charset, vector_size=args.size,
                     min_count=args.min_count)


if __name__ == "__main__":
    main()

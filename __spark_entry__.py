"""

Every query reads whole tables. Floating-point results are rounded on both sides,
because sums are formed in different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termfit.functions.logistic import gradient_weight, logistic_loss
from termfit.operators import factors, points, text
from termfit.operators.similarity import cosine_similarity
from termfit.plans.corpus import compare_documents, corpus_tfidf, score_corpus, score_parts
from termfit.plans.factorize import FactorModel, cross_validate, cross_validation_error, factorize, fit_and_save
from termfit.plans.logistic import LogisticModel, train_logistic
from termfit.session import durable, scratch_path
from termfit.sources.readers import (
    read_corpus,
    read_corpus_parts,
    read_folds,
    read_labelled,
    read_lines,
    read_pairs,
    read_table,
)
from termfit.sources.writers import write_corpus, write_ranked, write_scalar, write_scores

try:  # the training-data operators and their queries can be left out
    from termfit.llm import queries as training_data
except ImportError:
    training_data = None

Query = Callable[[SparkSession, str], DataFrame]

# Model settings shared by the queries and their SQL.
D = 4
SEED = 7
GAIN = 0.001
POWER = 0.2
FOLDS = 3
CV_ITERATIONS = 3
MF_ITERATIONS = 5
LR_ITERATIONS = 3
LAM = 1.0
BETA = {"value": 1.0, "k": -4.0}


# ---------------------------------------------------------------- inputs


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"])


def _conversations(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/conversations.parquet", ["conv_id", "text"])


def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    rating = 1 + (F.col("l_quantity") - 1) * 4 / 49
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_suppkey").alias("item_id"))
        .agg(F.avg(rating).alias("rating"))
    )


def _stored_ratings(spark: SparkSession, sf: str) -> DataFrame:
    """The ratings for queries that read them more than once."""
    return durable(_ratings(spark, sf))


def _folded(spark: SparkSession, sf: str) -> DataFrame:
    fold = (F.col("user_id") * 31 + F.col("item_id") * 17) % FOLDS
    return _ratings(spark, sf).withColumn("fold", fold.cast("int"))


def _points(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, f"{sf}/events.parquet", ["event_id", "event_type", "value", "props"])
    return events.select(
        F.col("event_id").alias("row_id"),
        F.expr("IF(event_type = 'error', 1, -1)").alias("y"),
        F.expr(
            "map('value', value / 10, 'k', from_json(props, 'k INT').k / 100, 'bias', 1D)"
        ).alias("x"),
    )


def _beta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BETA.items()), "feature string, coef double")


def _profiles(ratings: DataFrame, dist: str = "uniform") -> tuple[DataFrame, DataFrame]:
    users = factors.init_profiles(factors.entity_ids(ratings, "user_id"), D, SEED, "u", dist)
    items = factors.init_profiles(factors.entity_ids(ratings, "item_id"), D, SEED, "v", dist)
    return durable(users), durable(items)


def _residuals(ratings: DataFrame) -> DataFrame:
    return factors.residuals(ratings, *_profiles(ratings), D)


def _both_sides(users: DataFrame, items: DataFrame) -> DataFrame:
    sides = [
        table.select(F.lit(side).alias("side"), "id", F.posexplode("factors").alias("k", "value"))
        for side, table in (("u", users), ("v", items))
    ]
    return _rounded(sides[0].unionByName(sides[1]), 6, "value")


def _elements(profiles: DataFrame) -> DataFrame:
    return _rounded(profiles.select("id", F.posexplode("factors").alias("k", "value")), 6, "value")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# ---------------------------------------------------------------- text


def tokens_by_doc(spark, sf):
    tokens = text.tokenize(_documents(spark, sf), keep=["doc_id"])
    return tokens.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_tokens"))


def terms_by_doc(spark, sf):
    terms = text.terms(_documents(spark, sf), keep=["doc_id"])
    return terms.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_terms"))


def tf_corpus(spark, sf):
    return text.term_frequency(text.terms(_documents(spark, sf)))


def tf_by_doc(spark, sf):
    return text.document_term_frequency(_documents(spark, sf))


def tf_by_conversation(spark, sf):
    return text.term_frequency(text.terms(_conversations(spark, sf), keep=["conv_id"]), ["conv_id"])


def top_terms(spark, sf):
    return text.top_terms(tf_corpus(spark, sf))


def top_idf_terms(spark, sf):
    top = text.top_terms(tfidf_corpus_scores(spark, sf))
    return _rounded(top, 6, "tfidf")


def top_terms_from_text(spark, sf):
    return text.top_terms_from_text(_documents(spark, sf))


def df(spark, sf):
    return text.document_frequency(_documents(spark, sf))


def df_by_conversation(spark, sf):
    return text.document_frequency(_conversations(spark, sf), doc="conv_id")


def idf(spark, sf):
    return _rounded(text.inverse_document_frequency(_documents(spark, sf)), 6, "idf")


def tfidf(spark, sf):
    return _rounded(score_corpus(_documents(spark, sf)), 6, "tfidf")


def tfidf_corpus_scores(spark, sf):
    return corpus_tfidf(_documents(spark, sf))


def tfidf_corpus(spark, sf):
    return _rounded(tfidf_corpus_scores(spark, sf), 6, "tfidf")


def _corpus_cosine(spark, sf):
    idf = text.inverse_document_frequency(_documents(spark, sf))
    conversations = text.term_frequency(text.terms(_conversations(spark, sf)))
    return cosine_similarity(text.tfidf(tf_corpus(spark, sf), idf), text.tfidf(conversations, idf))


def cosine_corpora(spark, sf):
    return _rounded(_corpus_cosine(spark, sf), 6, "cosine")


def pairwise_cosine(spark, sf):
    docs = _documents(spark, sf)
    a = docs.select(F.col("doc_id").alias("doc_a"), (F.col("doc_id") + 1).alias("doc_b"))
    pairs = a.join(docs.select(F.col("doc_id").alias("doc_b")), "doc_b")
    return _rounded(compare_documents(score_corpus(docs, numbered=True), pairs), 6, "cosine")


# ---------------------------------------------------------------- factorization


def ratings_fixture(spark, sf):
    return _rounded(_ratings(spark, sf), 6, "rating")


def user_ids(spark, sf):
    return factors.entity_ids(_ratings(spark, sf), "user_id")


def item_ids(spark, sf):
    return factors.entity_ids(_ratings(spark, sf), "item_id")


def folds(spark, sf):
    return _rounded(_folded(spark, sf), 6, "rating")


def init_profiles_uniform(spark, sf):
    return _both_sides(*_profiles(_stored_ratings(spark, sf)))


def init_profiles_normal(spark, sf):
    return _both_sides(*_profiles(_stored_ratings(spark, sf), "normal"))


def residuals(spark, sf):
    res = _residuals(_stored_ratings(spark, sf)).select("user_id", "item_id", "rating", "delta")
    return _rounded(res, 6, "rating", "delta")


def squared_error(spark, sf):
    return _rounded(factors.squared_error(_residuals(_stored_ratings(spark, sf))), 4, "squared_error")


def penalty(spark, sf):
    users, items = _profiles(_stored_ratings(spark, sf))
    sides = [
        factors.profile_penalty(table, LAM, D).select(F.lit(side).alias("side"), "penalty")
        for side, table in (("u", users), ("v", items))
    ]
    return _rounded(sides[0].unionByName(sides[1]), 6, "penalty")


def objective(spark, sf):
    ratings = _stored_ratings(spark, sf)
    users, items = _profiles(ratings)
    res = factors.residuals(ratings, users, items, D)
    value = factors.objective(res, users, items, LAM, LAM, D)
    return _rounded(value, 4, "objective")


def rmse(spark, sf):
    """Profiles of fold 0's complement, scored on fold 0."""
    folded = durable(_folded(spark, sf))
    users, items = _profiles(folded.where(F.col("fold") != 0))
    value = factors.rmse(folded.where(F.col("fold") == 0), users, items, D)
    return _rounded(value, 6, "rmse", "rmse_scored")


def step_users(spark, sf):
    return _elements(factors.step_users(_residuals(_stored_ratings(spark, sf)), GAIN, LAM, D))


def step_items(spark, sf):
    return _elements(factors.step_items(_residuals(_stored_ratings(spark, sf)), GAIN, LAM, D))


def _mf_options(iterations: int) -> dict:
    return dict(
        d=D, seed=SEED, dist="uniform", gain=GAIN, power=POWER, lam=LAM, mu=LAM, maxiter=iterations
    )


def factorize_history(spark, sf):
    model = factorize(_ratings(spark, sf), **_mf_options(MF_ITERATIONS))
    history = model.history.select("iter", "objective", "gamma", "rmse", "n")
    return _rounded(_rounded(history, 4, "objective"), 6, "gamma", "rmse")


def factorize_profiles(spark, sf):
    model = factorize(_ratings(spark, sf), **_mf_options(MF_ITERATIONS))
    return _both_sides(model.users, model.items)


def cross_validation(spark, sf):
    result = cross_validate(_folded(spark, sf), FOLDS, **_mf_options(CV_ITERATIONS))
    return _rounded(result, 6, "rmse", "rmse_scored")


def cross_validation_mean(spark, sf):
    result = cross_validate(_folded(spark, sf), FOLDS, **_mf_options(CV_ITERATIONS))
    return _rounded(cross_validation_error(result), 4, "rmse", "rmse_scored")


# ---------------------------------------------------------------- logistic regression


def all_features(spark, sf):
    return points.all_features(_points(spark, sf))


def margins(spark, sf):
    return _rounded(points.margins(_points(spark, sf), _beta(spark)), 6, "m")


def row_losses(spark, sf):
    rows = points.margins(_points(spark, sf), _beta(spark)).select(
        "row_id", logistic_loss().alias("loss"), gradient_weight().alias("weight")
    )
    return _rounded(rows, 6, "loss", "weight")


def total_loss(spark, sf):
    return _rounded(points.total_loss(_points(spark, sf), _beta(spark), LAM), 4, "loss")


def total_gradient(spark, sf):
    return _rounded(points.total_gradient(_points(spark, sf), _beta(spark), LAM), 4, "g")


def grad_norm(spark, sf):
    gradient = points.total_gradient(_points(spark, sf), _beta(spark), LAM)
    return _rounded(points.grad_norm(gradient), 4, "grad_norm")


def axpy(spark, sf):
    gradient = points.total_gradient(_points(spark, sf), _beta(spark), LAM)
    step = points.axpy(_beta(spark), -0.001, gradient.withColumnRenamed("g", "coef"))
    return _rounded(step, 6, "coef")


def line_search(spark, sf):
    data, beta = _points(spark, sf), _beta(spark)
    gradient = durable(points.total_gradient(data, beta, LAM))
    fx = points.total_loss(data, beta, LAM).first()["loss"]
    norm = points.grad_norm(gradient).first()["grad_norm"]
    found = points.line_search(data, beta, gradient, fx, norm * norm, LAM)
    return spark.createDataFrame([(found.n, round(found.t, 12))], "n INT, t DOUBLE")


def confusion(spark, sf):
    return points.confusion(_points(spark, sf), _beta(spark))


def metrics(spark, sf):
    return _rounded(points.metrics(_points(spark, sf), _beta(spark)), 6, "acc", "pre", "rec")


def predict(spark, sf):
    model = LogisticModel(_beta(spark))
    return _rounded(model.predict(_points(spark, sf)), 6, "m")


def train_logistic_history(spark, sf):
    data = _points(spark, sf)
    model = train_logistic(data, lam=LAM, max_iter=LR_ITERATIONS, test=data)
    history = model.history.select("k", "loss", "grad_norm", "trials", "acc", "pre", "rec")
    return _rounded(_rounded(history, 4, "loss", "grad_norm"), 6, "acc", "pre", "rec")


def train_logistic_beta(spark, sf):
    model = train_logistic(_points(spark, sf), lam=LAM, max_iter=LR_ITERATIONS)
    return _rounded(model.beta, 6, "coef")


# ---------------------------------------------------------------- readers and writers


def corpus_from_files(spark, sf):
    """One file per document, read back as a corpus."""
    path = scratch_path(spark, "corpus")
    write_corpus(_documents(spark, sf), path)
    return _rounded(text.inverse_document_frequency(read_corpus(spark, path)), 6, "idf")


def tfidf_from_parts(spark, sf):
    """Files with many lines, read in parts and scored as whole documents."""
    path = scratch_path(spark, "parts")
    write_corpus(_documents(spark, sf), path)
    scored = score_parts(read_corpus_parts(spark, path))
    # the files' names vary, so the scores are added up per term
    return _rounded(scored.groupBy("term").agg(F.count("*").alias("df"), F.sum("tfidf").alias("tfidf")), 4, "tfidf")


def tf_from_lines(spark, sf):
    path = scratch_path(spark, "lines")
    _documents(spark, sf).select("text").write.text(path)
    return text.term_frequency(text.terms(read_lines(spark, path)))


def tf_text_roundtrip(spark, sf):
    path = scratch_path(spark, "tf")
    write_scores(tf_corpus(spark, sf), path, "text")
    return read_pairs(spark, path)


def idf_text_roundtrip(spark, sf):
    path = scratch_path(spark, "idf")
    scores = text.inverse_document_frequency(_documents(spark, sf)).select("term", "idf")
    write_scores(scores, path, "text")
    return _rounded(read_pairs(spark, path), 6, "value")


def tfidf_table_roundtrip(spark, sf):
    path = scratch_path(spark, "tfidf")
    write_scores(tfidf_corpus_scores(spark, sf), path)
    return _rounded(spark.read.parquet(path), 6, "tfidf")


def ranked_roundtrip(spark, sf):
    path = scratch_path(spark, "ranked")
    write_ranked(top_terms(spark, sf), path)
    return read_lines(spark, path)


def scalar_roundtrip(spark, sf):
    path = scratch_path(spark, "scalar")
    write_scalar(_corpus_cosine(spark, sf), path)
    return read_lines(spark, path)


def folds_roundtrip(spark, sf):
    path = scratch_path(spark, "folds")
    folded = _folded(spark, sf).persist()
    for k in range(FOLDS):
        part = folded.where(F.col("fold") == k).drop("fold")
        part.write.csv(f"{path}/fold{k}")
    folded.unpersist()
    return _rounded(read_folds(spark, path, FOLDS), 6, "rating")


def labelled_roundtrip(spark, sf):
    path = scratch_path(spark, "labelled")
    line = F.format_string("(%s, %d)", F.translate(F.to_json("x"), '"', "'"), F.col("y"))
    _points(spark, sf).select(line).write.text(path)
    names = ("value", "k", "bias")
    rows = read_labelled(spark, path)
    return _rounded(rows.select("y", *[F.col("x")[name].alias(name) for name in names]), 6, *names)


def factor_model_roundtrip(spark, sf):
    path = scratch_path(spark, "factors")
    fit_and_save(_ratings(spark, sf), path, **_mf_options(2))
    model = FactorModel.load(spark, path)
    return _both_sides(model.users, model.items)


def logistic_model_roundtrip(spark, sf):
    path = scratch_path(spark, "beta")
    train_logistic(_points(spark, sf), lam=LAM, max_iter=LR_ITERATIONS).save(path)
    return _rounded(LogisticModel.load(spark, path).predict(_points(spark, sf)), 6, "m")


def entry(spark: SparkSession) -> DataFrame:
    """The 20 most frequent terms of the document table."""
    return top_terms_from_text(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = {
        query.__name__: query
        for query in (
            tokens_by_doc,
            terms_by_doc,
            tf_corpus,
            tf_by_doc,
            tf_by_conversation,
            top_terms,
            top_idf_terms,
            top_terms_from_text,
            df,
            df_by_conversation,
            idf,
            tfidf,
            tfidf_corpus,
            cosine_corpora,
            pairwise_cosine,
            ratings_fixture,
            user_ids,
            item_ids,
            folds,
            init_profiles_uniform,
            init_profiles_normal,
            residuals,
            squared_error,
            penalty,
            objective,
            rmse,
            step_users,
            step_items,
            factorize_history,
            factorize_profiles,
            cross_validation,
            cross_validation_mean,
            all_features,
            margins,
            row_losses,
            total_loss,
            total_gradient,
            grad_norm,
            axpy,
            line_search,
            confusion,
            metrics,
            predict,
            train_logistic_history,
            train_logistic_beta,
            corpus_from_files,
            tfidf_from_parts,
            tf_from_lines,
            tf_text_roundtrip,
            idf_text_roundtrip,
            tfidf_table_roundtrip,
            ranked_roundtrip,
            scalar_roundtrip,
            folds_roundtrip,
            labelled_roundtrip,
            factor_model_roundtrip,
            logistic_model_roundtrip,
        )
    }
    return own | (training_data.QUERIES if training_data else {})


# ---------------------------------------------------------------- SQL counterparts

# The separators of a token, spelled out for the other engine.
_SQL_SEPARATORS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _sql_tokens(table: str, key: str) -> str:
    return (
        f"SELECT {key}, token FROM (SELECT {key}, "
        f"unnest(regexp_split_to_array(text, '{_SQL_SEPARATORS}')) AS token FROM {table}) "
        "WHERE token <> ''"
    )


def _sql_terms(table: str, key: str) -> str:
    term = r"regexp_replace(lower(token), '[^\p{L}]', '', 'g')"
    return f"SELECT {key}, {term} AS term FROM ({_sql_tokens(table, key)}) WHERE {term} <> ''"


_TERMS = f"terms AS MATERIALIZED ({_sql_terms('documents', 'doc_id')})"
_TALK = f"talk AS MATERIALIZED ({_sql_terms('conversations', 'conv_id')})"
_TF = f"{_TERMS}, tf AS MATERIALIZED (SELECT term, count(*) AS tf FROM terms GROUP BY term)"
_IDF = """
  dfs AS MATERIALIZED (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term),
  idfs AS MATERIALIZED (
    SELECT term, df, ln((SELECT count(*) FROM documents)::DOUBLE / df) AS idf FROM dfs)"""
_SCORES = f"""{_TERMS}, {_IDF},
  scores AS MATERIALIZED (
    SELECT doc_id, term, tf * idf AS tfidf
    FROM (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term) JOIN idfs USING (term))"""
_CORPUS_SCORES = f"{_TF}, {_IDF}, corpus AS (SELECT term, tf * idf AS tfidf FROM tf JOIN idfs USING (term))"
_TWO_CORPORA = f"""{_CORPUS_SCORES}, {_TALK},
  other AS (SELECT term, count(*) * any_value(idf) AS tfidf FROM talk JOIN idfs USING (term) GROUP BY term),
  cosine AS (
    SELECT (SELECT sum(a.tfidf * b.tfidf) FROM corpus a JOIN other b USING (term))
      / sqrt((SELECT sum(tfidf * tfidf) FROM corpus) * (SELECT sum(tfidf * tfidf) FROM other)) AS cosine)"""

_RATINGS = """r AS MATERIALIZED (
    SELECT o_custkey AS user_id, l_suppkey AS item_id, avg(1 + (l_quantity - 1) * 4 / 49) AS rating
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey, l_suppkey)"""
_FOLD = f"CAST((user_id * 31 + item_id * 17) % {FOLDS} AS INTEGER)"


def _sql_hash(side: str, key: str, k: str, stream: str = "") -> str:
    parts = f"'{SEED}', '{side}', {key}, {k}" + (f", '{stream}'" if stream else "")
    return f"('0x' || substr(md5(concat_ws(':', {parts})), 1, 13))::BIGINT"


def _sql_uniform(side: str, key: str, k: str) -> str:
    return f"({_sql_hash(side, key, k)} / 4503599627370496.0::DOUBLE - 0.5)"


def _sql_normal(side: str, key: str, k: str) -> str:
    radius = f"(({_sql_hash(side, key, k, '1')} + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)"
    angle = f"({_sql_hash(side, key, k, '2')} / 4503599627370496.0::DOUBLE)"
    return f"(sqrt(-2 * ln({radius})) * cos(2 * pi() * {angle}))"


def _sql_draws(draw) -> str:
    sides = (("u", "user_id"), ("v", "item_id"))
    return f"WITH {_RATINGS} " + " UNION ALL ".join(
        f"SELECT '{side}' AS side, id, k::INTEGER AS k, round({draw(side, 'id', 'k')}, 6) AS value "
        f"FROM (SELECT DISTINCT {key} AS id FROM r), (SELECT unnest(range({D})) AS k)"
        for side, key in sides
    )


def _sql_profiles(name: str, side: str, key: str, source: str) -> str:
    values = ", ".join(f"{_sql_uniform(side, 'id', str(k))} AS f{k}" for k in range(D))
    return f"{name} AS MATERIALIZED (SELECT id, {values} FROM (SELECT DISTINCT {key} AS id FROM {source}))"


def _sql_joined(name: str, source: str, users: str, items: str, kind: str = "JOIN") -> str:
    columns = ", ".join(f"u.f{k} AS u{k}, v.f{k} AS v{k}" for k in range(D))
    dot = " + ".join(f"u.f{k} * v.f{k}" for k in range(D))
    return (
        f"{name} AS MATERIALIZED (SELECT user_id, item_id, rating, {columns}, {dot} - rating AS delta "
        f"FROM {source} {kind} {users} u ON u.id = user_id {kind} {items} v ON v.id = item_id)"
    )


def _sql_step(name: str, joined: str, key: str, own: str, other: str, gamma: float) -> str:
    values = ", ".join(
        f"any_value({own}{k}) - {gamma!r}::DOUBLE * (sum(2 * delta * {other}{k}) + 2 * {LAM} * any_value({own}{k})) AS f{k}"
        for k in range(D)
    )
    return f"{name} AS MATERIALIZED (SELECT {key} AS id, {values} FROM {joined} GROUP BY {key})"


def _sql_training(source: str, prefix: str, iterations: int) -> str:
    parts = [
        _sql_profiles(f"{prefix}u1", "u", "user_id", source),
        _sql_profiles(f"{prefix}v1", "v", "item_id", source),
    ]
    for i in range(1, iterations + 1):
        gamma = GAIN / i**POWER
        joined = f"{prefix}j{i}"
        parts.append(_sql_joined(joined, source, f"{prefix}u{i}", f"{prefix}v{i}"))
        parts.append(_sql_step(f"{prefix}u{i + 1}", joined, "user_id", "u", "v", gamma))
        parts.append(_sql_step(f"{prefix}v{i + 1}", joined, "item_id", "v", "u", gamma))
    return ", ".join(parts)


def _sql_norm(profiles: str) -> str:
    return f"(SELECT sum({' + '.join(f'f{k} * f{k}' for k in range(D))}) FROM {profiles})"


def _sql_elements(profiles: str, side: str = "") -> str:
    tag = f"'{side}' AS side, " if side else ""
    return " UNION ALL ".join(
        f"SELECT {tag}id, {k} AS k, round(f{k}, 6) AS value FROM {profiles}" for k in range(D)
    )


def _sql_factor_history() -> str:
    rows = [
        f"SELECT {i} AS iter, "
        f"round((SELECT sum(delta * delta) FROM j{i}) + {LAM} * {_sql_norm(f'u{i}')} + {LAM} * {_sql_norm(f'v{i}')}, 4) AS objective, "
        f"round({GAIN / i**POWER!r}::DOUBLE, 6) AS gamma, "
        f"round(sqrt((SELECT sum(delta * delta) FROM j{i}) / (SELECT count(*) FROM r)), 6) AS rmse, "
        "(SELECT count(*) FROM r) AS n"
        for i in range(1, MF_ITERATIONS + 1)
    ]
    return f"WITH {_RATINGS}, {_sql_training('r', '', MF_ITERATIONS)} " + " UNION ALL ".join(rows)


def _sql_trained(iterations: int) -> str:
    last = iterations + 1
    return (
        f"WITH {_RATINGS}, {_sql_training('r', '', iterations)} "
        f"{_sql_elements(f'u{last}', 'u')} UNION ALL {_sql_elements(f'v{last}', 'v')}"
    )


def _sql_cross_validation() -> str:
    parts = [_RATINGS]
    rows = []
    for k in range(FOLDS):
        p = f"f{k}_"
        parts.append(f"{p}train AS MATERIALIZED (SELECT * FROM r WHERE {_FOLD} <> {k})")
        parts.append(f"{p}test AS MATERIALIZED (SELECT * FROM r WHERE {_FOLD} = {k})")
        parts.append(_sql_training(f"{p}train", p, CV_ITERATIONS))
        last = CV_ITERATIONS
        parts.append(_sql_joined(f"{p}held", f"{p}test", f"{p}u{last}", f"{p}v{last}"))
        error = f"(SELECT sum(delta * delta) FROM {p}held)"
        rows.append(
            f"SELECT {k} AS fold, (SELECT count(*) FROM {p}train) AS n_train, "
            f"(SELECT count(*) FROM {p}test) AS n_test, {CV_ITERATIONS} AS iterations, "
            f"round(sqrt({error} / (SELECT count(*) FROM {p}test)), 6) AS rmse, "
            f"round(sqrt({error} / (SELECT count(*) FROM {p}held)), 6) AS rmse_scored"
        )
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(rows)


_START = f"{_RATINGS}, {_sql_profiles('u1', 'u', 'user_id', 'r')}, {_sql_profiles('v1', 'v', 'item_id', 'r')}"
_JOINED = f"{_START}, {_sql_joined('j1', 'r', 'u1', 'v1')}"

_WIDE = """wide AS MATERIALIZED (
    SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 1 ELSE -1 END AS y, value / 10 AS value,
      CAST(json_extract(props, '$.k') AS INTEGER) / 100 AS k, 1.0::DOUBLE AS bias FROM events)"""
_LONG = f"""{_WIDE}, d AS MATERIALIZED (
    SELECT id, y, 'value' AS f, value AS x FROM wide UNION ALL SELECT id, y, 'k', k FROM wide
    UNION ALL SELECT id, y, 'bias', bias FROM wide)"""
_BETA0 = "b0 AS (SELECT f, coalesce(c, 0.0::DOUBLE) AS c FROM (SELECT DISTINCT f FROM d) LEFT JOIN (" + (
    " UNION ALL ".join(f"SELECT '{f}' AS f, {c}::DOUBLE AS c" for f, c in BETA.items())
) + ") USING (f))"
_ZERO = "b0 AS (SELECT DISTINCT f, 0.0::DOUBLE AS c FROM d)"


def _sql_loss(z: str) -> str:
    return f"(ln(1 + exp(-abs({z}))) + greatest(-({z}), 0))"


def _sql_margin(k: int) -> str:
    return (
        f"m{k} AS MATERIALIZED (SELECT id, any_value(y) AS y, sum(x * c) AS m FROM d JOIN b{k} USING (f) GROUP BY id)"
    )


def _sql_gradient(k: int) -> str:
    return f"""{_sql_margin(k)},
  g{k} AS MATERIALIZED (
    SELECT f, s + 2 * {LAM} * c AS g, c
    FROM (SELECT f, sum(-d.y / (1 + exp(d.y * m)) * x) AS s FROM d JOIN m{k} ON m{k}.id = d.id GROUP BY f) JOIN b{k} USING (f)),
  a{k} AS MATERIALIZED (
    SELECT (SELECT sum({_sql_loss('y * m')}) FROM m{k}) + {LAM} * sum(c * c) AS fx,
      sum(c * c) AS bb, sum(c * g) AS bg, sum(g * g) AS gn FROM g{k})"""


def _sql_search(k: int) -> str:
    trial = f"y * (m - pow(0.6::DOUBLE, n) * q)"
    return f"""q{k} AS MATERIALIZED (
    SELECT d.id, any_value(d.y) AS y, any_value(m) AS m, sum(x * g) AS q
    FROM d JOIN m{k} ON m{k}.id = d.id JOIN g{k} USING (f) GROUP BY d.id),
  t{k} AS MATERIALIZED (
    SELECT min(n)::INTEGER AS n
    FROM (SELECT n, sum({_sql_loss(trial)}) AS l FROM q{k}, (SELECT unnest(range(64)) AS n) GROUP BY n), a{k}
    WHERE NOT l + {LAM} * (bb - 2 * pow(0.6::DOUBLE, n) * bg + pow(0.6::DOUBLE, 2 * n) * gn) > fx - 0.2 * pow(0.6::DOUBLE, n) * gn)"""


def _sql_descent(iterations: int) -> str:
    parts = [_LONG, _ZERO]
    for k in range(iterations):
        parts += [_sql_gradient(k), _sql_search(k)]
        parts.append(
            f"b{k + 1} AS MATERIALIZED (SELECT f, c - pow(0.6::DOUBLE, n) * g AS c FROM g{k}, t{k})"
        )
    return ", ".join(parts)


_COUNTS = """count(*) FILTER (m > 0) AS p, count(*) FILTER (NOT m > 0) AS n,
    count(*) FILTER (m > 0 AND y = 1) AS tp, count(*) FILTER (m > 0 AND y = -1) AS fp,
    count(*) FILTER (NOT m > 0 AND y = -1) AS tn, count(*) FILTER (NOT m > 0 AND y = 1) AS fn"""
_RATES = """round((tp + tn)::DOUBLE / nullif(p + n, 0), 6) AS acc,
    round(tp::DOUBLE / nullif(tp + fp, 0), 6) AS pre, round(tp::DOUBLE / nullif(tp + fn, 0), 6) AS rec"""


def _sql_logistic_history() -> str:
    parts = [_sql_descent(LR_ITERATIONS)]
    rows = []
    for k in range(LR_ITERATIONS):
        if k + 1 == LR_ITERATIONS:
            parts.append(_sql_margin(k + 1))
        rows.append(
            f"SELECT {k} AS k, round(fx, 4) AS loss, round(sqrt(gn), 4) AS grad_norm, t{k}.n AS trials, {_RATES} "
            f"FROM a{k}, t{k}, (SELECT {_COUNTS} FROM m{k + 1}) AS counts(p, n, tp, fp, tn, fn)"
        )
    rows = [row.replace("(tp + tn)::DOUBLE / nullif(p + n, 0)", "(tp + tn)::DOUBLE / nullif(p + counts.n, 0)") for row in rows]
    return f"WITH {', '.join(parts)} " + " UNION ALL ".join(rows)


_FIXED = f"WITH {_LONG}, {_BETA0}, "
_PREDICT = "id AS row_id, y, round(m, 6) AS m, CASE WHEN m > 0 THEN 1 ELSE -1 END AS y_hat"


def oracle_sql() -> dict[str, str]:
    tf = f"WITH {_TF} SELECT term, tf FROM tf"
    top = f"{tf} ORDER BY tf DESC, term LIMIT 20"
    idf = f"WITH {_TERMS}, {_IDF} SELECT term, df, round(idf, 6) AS idf FROM idfs"
    corpus = f"WITH {_CORPUS_SCORES} SELECT term, round(tfidf, 6) AS tfidf FROM corpus"
    folds = f"WITH {_RATINGS} SELECT user_id, item_id, round(rating, 6) AS rating, {_FOLD} AS fold FROM r"
    last = LR_ITERATIONS
    own = {
        "tokens_by_doc": f"SELECT doc_id, count(*) AS n_tokens FROM ({_sql_tokens('documents', 'doc_id')}) GROUP BY doc_id",
        "terms_by_doc": f"WITH {_TERMS} SELECT doc_id, count(*) AS n_terms FROM terms GROUP BY doc_id",
        "tf_corpus": tf,
        "tf_by_doc": f"WITH {_TERMS} SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term",
        "tf_by_conversation": f"WITH {_TALK} SELECT conv_id, term, count(*) AS tf FROM talk GROUP BY conv_id, term",
        "top_terms": top,
        "top_idf_terms": f"WITH {_CORPUS_SCORES} SELECT term, round(tfidf, 6) AS tfidf FROM corpus ORDER BY corpus.tfidf DESC, term LIMIT 20",
        "top_terms_from_text": top,
        "df": f"WITH {_TERMS}, {_IDF} SELECT term, df FROM dfs",
        "df_by_conversation": f"WITH {_TALK} SELECT term, count(DISTINCT conv_id) AS df FROM talk GROUP BY term",
        "idf": idf,
        "tfidf": f"WITH {_SCORES} SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM scores",
        "tfidf_corpus": corpus,
        "cosine_corpora": f"WITH {_TWO_CORPORA} SELECT round(cosine, 6) AS cosine FROM cosine",
        "pairwise_cosine": f"""WITH {_SCORES},
  norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS norm FROM scores GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
  dots AS (
    SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, sum(a.tfidf * b.tfidf) AS ab
    FROM scores a JOIN scores b ON b.doc_id = a.doc_id + 1 AND b.term = a.term GROUP BY a.doc_id, b.doc_id)
SELECT doc_a, doc_b, round(coalesce(ab, 0) / nullif(na.norm * nb.norm, 0), 6) AS cosine
FROM pairs LEFT JOIN dots USING (doc_a, doc_b)
  LEFT JOIN norms na ON na.doc_id = doc_a LEFT JOIN norms nb ON nb.doc_id = doc_b""",
        "ratings_fixture": f"WITH {_RATINGS} SELECT user_id, item_id, round(rating, 6) AS rating FROM r",
        "user_ids": f"WITH {_RATINGS} SELECT DISTINCT user_id AS id FROM r",
        "item_ids": f"WITH {_RATINGS} SELECT DISTINCT item_id AS id FROM r",
        "folds": folds,
        "init_profiles_uniform": _sql_draws(_sql_uniform),
        "init_profiles_normal": _sql_draws(_sql_normal),
        "residuals": f"WITH {_JOINED} SELECT user_id, item_id, round(rating, 6) AS rating, round(delta, 6) AS delta FROM j1",
        "squared_error": f"WITH {_JOINED} SELECT round(sum(delta * delta), 4) AS squared_error FROM j1",
        "penalty": f"WITH {_START} SELECT 'u' AS side, round({LAM} * {_sql_norm('u1')}, 6) AS penalty "
        f"UNION ALL SELECT 'v', round({LAM} * {_sql_norm('v1')}, 6)",
        "objective": f"WITH {_JOINED} SELECT round((SELECT sum(delta * delta) FROM j1) + {LAM} * {_sql_norm('u1')} "
        f"+ {LAM} * {_sql_norm('v1')}, 4) AS objective",
        "rmse": f"""WITH {_RATINGS}, train AS (SELECT * FROM r WHERE {_FOLD} <> 0), test AS (SELECT * FROM r WHERE {_FOLD} = 0),
  {_sql_profiles('u1', 'u', 'user_id', 'train')}, {_sql_profiles('v1', 'v', 'item_id', 'train')},
  {_sql_joined('j1', 'test', 'u1', 'v1', 'LEFT JOIN')}
SELECT round(sqrt(coalesce(sum(delta * delta), 0) / count(*)), 6) AS rmse,
  round(sqrt(coalesce(sum(delta * delta), 0) / nullif(count(delta), 0)), 6) AS rmse_scored,
  count(*) AS n, count(delta) AS n_scored FROM j1""",
        "step_users": f"WITH {_JOINED}, {_sql_step('u2', 'j1', 'user_id', 'u', 'v', GAIN)} {_sql_elements('u2')}",
        "step_items": f"WITH {_JOINED}, {_sql_step('v2', 'j1', 'item_id', 'v', 'u', GAIN)} {_sql_elements('v2')}",
        "factorize_history": _sql_factor_history(),
        "factorize_profiles": _sql_trained(MF_ITERATIONS),
        "cross_validation": _sql_cross_validation(),
        "cross_validation_mean": "SELECT count(*) AS folds, round(avg(rmse), 4) AS rmse, "
        f"round(avg(rmse_scored), 4) AS rmse_scored FROM ({_sql_cross_validation()})",
        "all_features": f"WITH {_LONG} SELECT DISTINCT f AS feature FROM d",
        "margins": f"{_FIXED}{_sql_margin(0)} SELECT id AS row_id, y, round(m, 6) AS m FROM m0",
        "row_losses": f"{_FIXED}{_sql_margin(0)} SELECT id AS row_id, round({_sql_loss('y * m')}, 6) AS loss, "
        "round(-y / (1 + exp(y * m)), 6) AS weight FROM m0",
        "total_loss": f"{_FIXED}{_sql_gradient(0)} SELECT round(fx, 4) AS loss FROM a0",
        "total_gradient": f"{_FIXED}{_sql_gradient(0)} SELECT f AS feature, round(g, 4) AS g FROM g0",
        "grad_norm": f"{_FIXED}{_sql_gradient(0)} SELECT round(sqrt(gn), 4) AS grad_norm FROM a0",
        "axpy": f"{_FIXED}{_sql_gradient(0)} SELECT f AS feature, round(c - 0.001::DOUBLE * g, 6) AS coef FROM g0",
        "line_search": f"{_FIXED}{_sql_gradient(0)}, {_sql_search(0)} "
        "SELECT n, round(pow(0.6::DOUBLE, n), 12) AS t FROM t0",
        "confusion": f"{_FIXED}{_sql_margin(0)} SELECT {_COUNTS} FROM m0",
        "metrics": f"{_FIXED}{_sql_margin(0)} SELECT {_RATES} FROM (SELECT {_COUNTS} FROM m0)",
        "predict": f"{_FIXED}{_sql_margin(0)} SELECT {_PREDICT} FROM m0",
        "train_logistic_history": _sql_logistic_history(),
        "train_logistic_beta": f"WITH {_sql_descent(last)} SELECT f AS feature, round(c, 6) AS coef FROM b{last}",
        "corpus_from_files": idf,
        "tfidf_from_parts": f"WITH {_SCORES} SELECT term, count(*) AS df, round(sum(tfidf), 4) AS tfidf FROM scores GROUP BY term",
        "tf_from_lines": tf,
        "tf_text_roundtrip": f"WITH {_TF} SELECT term, tf::DOUBLE AS value FROM tf",
        "idf_text_roundtrip": f"WITH {_TERMS}, {_IDF} SELECT term, round(idf, 6) AS value FROM idfs",
        "tfidf_table_roundtrip": corpus,
        "ranked_roundtrip": f"SELECT printf('(%s, %f)', term, tf::DOUBLE) AS text FROM ({top})",
        "scalar_roundtrip": f"WITH {_TWO_CORPORA} SELECT printf('%f', cosine) AS text FROM cosine",
        "folds_roundtrip": folds,
        "labelled_roundtrip": f"WITH {_WIDE} SELECT y, round(value, 6) AS value, round(k, 6) AS k, bias FROM wide",
        "factor_model_roundtrip": _sql_trained(2),
        "logistic_model_roundtrip": f"WITH {_sql_descent(last)}, {_sql_margin(last)} SELECT {_PREDICT} FROM m{last}",
    }
    return own | (training_data.ORACLE_SQL if training_data else {})

"""Text scoring, matrix factorization and sparse logistic regression on Spark DataFrames."""

from termfit.functions.hashing import hash_normal, hash_uniform
from termfit.functions.logistic import gradient_weight, logistic_loss
from termfit.functions.text import normalize_term, term_array
from termfit.functions.vectors import dot
from termfit.operators.factors import (
    entity_ids,
    gain_schedule,
    init_profiles,
    objective,
    profile_penalty,
    residuals,
    rmse,
    squared_error,
    step_items,
    step_users,
)
from termfit.operators.points import (
    all_features,
    axpy,
    confusion,
    grad_norm,
    line_search,
    margins,
    metrics,
    predict,
    total_gradient,
    total_loss,
)
from termfit.operators.similarity import cosine_similarity, pairwise_cosine
from termfit.operators.text import (
    document_frequency,
    document_term_frequency,
    inverse_document_frequency,
    term_frequency,
    terms,
    tfidf,
    tokenize,
    top_terms,
    top_terms_from_text,
)
from termfit.plans.corpus import compare_documents, score_corpus, score_parts
from termfit.plans.factorize import (
    FactorModel,
    cross_validate,
    cross_validation_error,
    factorize,
    fit_and_save,
)
from termfit.plans.logistic import LogisticModel, train_logistic
from termfit.sources.readers import (
    read_corpus,
    read_corpus_parts,
    read_folds,
    read_labelled,
    read_lines,
    read_pairs,
    read_ratings,
    read_table,
)
from termfit.sources.writers import write_corpus, write_ranked, write_scalar, write_scores

__all__ = sorted(name for name in globals() if not name.startswith("_"))

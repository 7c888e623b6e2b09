"""Binary credit-default flow: encode, null policy, truncate, split, scale, balance, fit, report, refit, score."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.models.trees import boosted_trees
from rowloom.operators.clean import drop_null_rows, fill_median
from rowloom.operators.encode import apply_scale, label_dictionary, label_encode, standard_state
from rowloom.operators.metrics import classification_report, confusion_matrix
from rowloom.operators.resample import smote
from rowloom.operators.select import columns_of_kind, truncate_to_int
from rowloom.operators.split import holdout_split


@dataclass
class CreditResult:
    holdout: DataFrame  # scored holdout rows
    confusion: DataFrame
    report: DataFrame
    predictions: DataFrame  # key, prediction for the scoring table


def _boosting(df, features, label):
    return boosted_trees(df, features, label, loss="logistic", learning_rate=0.01, max_depth=4, n_estimators=850)


def prepare(train, score, key, target, sparse=(), medians_from="train"):
    """Both tables as numbers: train loses null rows, score gets medians."""
    strings = [c for c in columns_of_kind(train, "string") if c not in (key, target, *sparse)]
    state = label_dictionary(train, columns=strings).persist() if strings else None
    if strings:
        train, score = (label_encode(t, state, strings, unseen="last") for t in (train, score))
    train = drop_null_rows(train, drop=sparse)
    score = score.drop(*sparse)
    features = [c for c in train.columns if c not in (key, target)]
    score = fill_median(score, features, stats_from=train if medians_from == "train" else None)
    return truncate_to_int(train, columns_of_kind(train, "float")), truncate_to_int(score), features


def _fit_balanced(train, key, target, features, fit, balance, seed):
    state = standard_state(train, features).persist()
    scaled = apply_scale(train, state)
    rows = smote(scaled, key, target, features, seed=seed) if balance else scaled
    return fit(rows, features, target), state


def credit_default(
    train, score, key, target, sparse=(), share=0.2, fit=_boosting, balance=True, medians_from="train", seed=42
) -> CreditResult:
    train, score, features = prepare(train, score, key, target, sparse, medians_from)
    train = train.persist()
    fit_part, held = holdout_split(train, key, share, seed)
    model, state = _fit_balanced(fit_part, key, target, features, fit, balance, seed)
    judged = model.score(apply_scale(held, state))
    final, state = _fit_balanced(train, key, target, features, fit, balance, seed)
    predictions = final.score(apply_scale(score, state)).select(key, F.col("prediction").alias(target))
    return CreditResult(
        judged, confusion_matrix(judged, target, "prediction"), classification_report(judged, target, "prediction"), predictions
    )

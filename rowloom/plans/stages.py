"""Fit-and-score chains: a list of stages that behaves like one model."""

from rowloom.operators.encode import apply_scale, polynomial_features, polynomial_names, standard_state
from rowloom.operators.reduce import pca_fit


class Scale:
    def fit(self, df, features):
        self.state = standard_state(df, features).persist()
        return features

    def apply(self, df):
        return apply_scale(df, self.state)


class Polynomial:
    """Degree-2 terms without the bias column (models add their own)."""

    def fit(self, df, features):
        self.features, self.names = features, polynomial_names(features)
        return self.names

    def apply(self, df):
        keep = [c for c in df.columns if c not in self.names]
        return polynomial_features(df, self.features, keep=[c for c in keep if c not in self.features], bias=False)


class Components:
    def __init__(self, k=None, share=None):
        self.k, self.share = k, share

    def fit(self, df, features):
        self.projection = pca_fit(df, features, self.k, self.share)
        return self.projection.names()

    def apply(self, df):
        return self.projection.transform(df)


class Chain:
    """Stages in order, then `fit_model(df, features, target)`."""

    def __init__(self, stages, fit_model):
        self.stages, self.fit_model = stages, fit_model

    def fit(self, df, features, target):
        features = list(features)
        for s in self.stages:
            features = s.fit(df, features)
            df = s.apply(df)
        self.features = features
        self.model = self.fit_model(df, features, target)
        return self

    def score(self, df, **options):
        for s in self.stages:
            df = s.apply(df)
        return self.model.score(df, **options)

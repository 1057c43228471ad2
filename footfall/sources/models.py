"""Fitted models on disk."""

from __future__ import annotations


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(kind: type, path: str):
    """``kind`` is the model class, for example ``NaiveBayesModel``."""
    return kind.load(path)

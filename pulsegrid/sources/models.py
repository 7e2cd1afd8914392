"""Saved models."""

from pyspark.ml import PipelineModel


def save_model(model, path):
    model.write().overwrite().save(path)


def load_model(path):
    return PipelineModel.load(path)

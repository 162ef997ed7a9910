"""The cleaning steps and the table operators built on them."""

from terrace.operators.base import Step
from terrace.operators.lemmas import Lemmatize
from terrace.operators.nulls import HandleNulls, HandleNullsModel
from terrace.operators.rows import RemoveDuplicates, RemoveNulls
from terrace.operators.values import ConvertTypes, NormalizeText, NormalizeTimestamp

__all__ = [
    "ConvertTypes",
    "HandleNulls",
    "HandleNullsModel",
    "Lemmatize",
    "NormalizeText",
    "NormalizeTimestamp",
    "RemoveDuplicates",
    "RemoveNulls",
    "Step",
]

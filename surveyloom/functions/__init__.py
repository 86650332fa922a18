from surveyloom.functions.columns import quoted
from surveyloom.functions.labels import money_label, percent_label, pt_count, pt_number
from surveyloom.functions.measures import answered, mean_2dp, mentions, percent, weighted_mean
from surveyloom.functions.numbers import coerce_numbers, to_number, whole_number

__all__ = [
    "answered",
    "coerce_numbers",
    "mean_2dp",
    "mentions",
    "money_label",
    "percent",
    "percent_label",
    "pt_count",
    "pt_number",
    "quoted",
    "to_number",
    "weighted_mean",
    "whole_number",
]

from millrace.plans.clean import CleanReport, clean_lines, run_clean
from millrace.plans.flatten import FlattenReport, entities, items, run_flatten
from millrace.plans.land import land_in_chunks
from millrace.plans.load import run_load
from millrace.plans.split import split_to_shards

__all__ = [
    "CleanReport",
    "FlattenReport",
    "clean_lines",
    "entities",
    "items",
    "land_in_chunks",
    "run_clean",
    "run_flatten",
    "run_load",
    "split_to_shards",
]

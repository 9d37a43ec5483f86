"""The registered queries of the matching engine, with equivalent DuckDB SQL where SQL can express them."""

from pairforge.queries import calibrated, feedback, matching, replies, scoring, sources, steps, texts

QUERIES = {**texts.QUERIES, **matching.QUERIES, **scoring.QUERIES, **feedback.QUERIES, **sources.QUERIES, **replies.QUERIES, **steps.QUERIES, **calibrated.QUERIES}
SQL = {**texts.SQL, **matching.SQL, **scoring.SQL, **feedback.SQL, **sources.SQL, **replies.SQL, **steps.SQL, **calibrated.SQL}

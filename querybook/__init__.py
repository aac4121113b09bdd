"""Registered queries over the given tables, each with its SQL counterpart where SQL can express it."""

from . import analytics, cleaning, evaluation, health, live, profile, serving, storage, streams, training, writes

BOOKS = [cleaning, serving, analytics, health, writes, live, evaluation, profile, training, streams, storage]


def all_queries():
    return {name: fn for book in BOOKS for name, fn in book.query.queries.items()}


def all_oracles():
    return {name: sql for book in BOOKS for name, sql in book.query.oracles.items()}

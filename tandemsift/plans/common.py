"""How a query module registers its queries."""

from __future__ import annotations

from collections.abc import Callable

from ..sources.fixtures import VIEWS, view, with_views


def register(queries: dict, oracles: dict) -> Callable:
    """A decorator maker: the query of a name takes the named views; so does its oracle, a SELECT or WITH.

    An oracle that goes by other views names them.
    """

    def named(name: str, views: str, oracle: str | None = None, recursive: bool = False, oracle_views: str = "") -> Callable:
        names = views.split()

        def keep(f: Callable) -> Callable:
            queries[name] = lambda spark, sf_dir: f(*(view(spark, sf_dir, v) for v in names))
            if oracle is not None:
                made, body = [v for v in oracle_views.split() or names if v in VIEWS], oracle.strip()
                if made:
                    body = with_views(*made, recursive=recursive) + (", " + body[5:] if body.startswith("WITH ") else " " + body)
                oracles[name] = body
            return f

        return keep

    return named

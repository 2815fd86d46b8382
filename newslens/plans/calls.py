"""The reference's 26 timed query calls, as one list.

Defaults are the parameters its scripts use; pass others (the bench passes
values present in the fixture data).  Each entry is ``(name, thunk)``; the
thunk builds the query DataFrame when called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from newslens.plans import queries as Q

Call = tuple[str, Callable[[], DataFrame]]

# --- Fixed values: the reference scripts' call parameters ----------------------
DAY = (2022, 1, 20)
COUNTRY = "FR"
LANGUAGE = "eng"
SOURCE = "msn.com"
SOURCE_LIMIT = 100
THEME_K = {"year": 3, "month": 3, "day": 1}
LOCATION_K = {"year": 3, "month": 3, "day": 1}
PERSON_K = {"year": 10, "month": 3, "day": 1}
PAIR = ("France", "United States")
PAIR_THEME_K = 3
# ------------------------------------------------------------------------------

GRANULARITIES = ("year", "month", "day")


def reference_calls(event_mentions: DataFrame, articles: DataFrame,
                    day: tuple[int, int, int] = DAY, country: str = COUNTRY,
                    language: str = LANGUAGE, source: str = SOURCE,
                    pair: tuple[str, str] = PAIR) -> list[Call]:
    em, art = event_mentions, articles
    calls: list[Call] = [
        ("q1_one_language",
         lambda: Q.articles_by_date_country_language(em, *day, country, language)),
        ("q1_all_languages", lambda: Q.articles_by_date_country_language(em, *day, country)),
    ]
    for g in GRANULARITIES:
        calls.append((f"q2_{g}", lambda g=g: Q.most_mentioned_events(em, country, g)))
    for g in GRANULARITIES:
        calls.append((f"q31_{g}", lambda g=g: Q.all_by_source(art, source, g, SOURCE_LIMIT)))
    for g in GRANULARITIES:
        calls.append((f"q32_{g}", lambda g=g: Q.tone_and_count_by_source(art, source, g)))
    for g in GRANULARITIES:
        calls.append((f"q33_{g}",
                      lambda g=g: Q.themes_by_source(art, source, g, THEME_K[g])))
    for g in GRANULARITIES:
        calls.append((f"q34_{g}",
                      lambda g=g: Q.locations_by_source(art, source, g, LOCATION_K[g])))
    for g in GRANULARITIES:
        calls.append((f"q35_{g}",
                      lambda g=g: Q.persons_by_source(art, source, g, PERSON_K[g])))
    for g in GRANULARITIES:
        calls.append((f"q41_{g}", lambda g=g: Q.tone_and_count_by_countries(art, *pair, g)))
    for g in GRANULARITIES:
        calls.append((f"q42_{g}",
                      lambda g=g: Q.themes_by_countries(art, *pair, g, PAIR_THEME_K)))
    return calls

"""Outcome of a fetched match, from the landed responses."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from touchline.operators.filters import in_league


def fetch_status(
    page_status: Column, info: Column, api_status: Column, api_json: Column
) -> Column:
    """First failure wins. A NULL status means the request itself failed.

    Fixed values: the status names. ``api_decode_error`` is ours: a roster that is not
    JSON sets its match aside instead of stopping the run.
    """
    return (
        F.when(page_status.isNull(), "understat_request_error")
        .when(page_status == 404, "understat_404_error")
        .when(info.isNull(), "missing_match_data")
        .when(~in_league(info["league"], info["league_id"]), "not_epl")
        .when(api_status.isNull(), "api_request_error")
        .when(api_status == 404, "api_404_error")
        .when(F.json_object_keys(api_json).isNull(), "api_decode_error")
        .otherwise("ok")
    )

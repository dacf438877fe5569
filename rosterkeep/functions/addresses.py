"""Candidate addresses of an account."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.functions.text import is_blank


def organisation_address(c: Column, suffix: str, domain: str) -> Column:
    """Address in the organisation's domain: suffix off (any case), local part only, domain on.

    NULL gives the bare ``@domain``, which is a candidate like any other.
    """
    bare = F.coalesce(c, F.lit(""))
    if suffix:
        bare = F.regexp_replace(bare, f"(?i){re.escape(suffix)}$", "")
    return F.concat(F.substring_index(bare, "@", 1), F.lit("@" + domain))


#: Columns of the candidates, in the order they are tried.
CANDIDATES = ("_own", "_by_username", "_by_email")


def with_candidates(df: DataFrame, suffix: str, domain: str) -> DataFrame:
    """Accounts with their candidates: own e-mail, address formed from the user name, address formed from the e-mail.

    A candidate that is blank or repeats an earlier one is NULL. Three plain columns, as Spark compiles those and would
    interpret the functions over arrays.
    """
    own, by_username, by_email = CANDIDATES
    formed = df.withColumns(
        {
            own: F.when(~is_blank(F.col("email")), F.col("email")),
            by_username: organisation_address(F.col("username"), suffix, domain),
            by_email: organisation_address(F.col("email"), suffix, domain),
        }
    )
    return formed.withColumns(
        {
            by_username: F.when(~F.col(by_username).eqNullSafe(F.col(own)), F.col(by_username)),
            by_email: F.when(
                ~F.col(by_email).eqNullSafe(F.col(own)) & (F.col(by_email) != F.col(by_username)), F.col(by_email)
            ),
        }
    )

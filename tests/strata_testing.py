"""Values and small functions that the test modules share."""

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def T(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)

"""Run parameters for the driver's tables. The original analysis is
written for 2018-2023 with 2020-2021 excluded; the test tables span
1995-2001, so the same roles map onto these years."""

PRE_YEARS = (1996, 1997)
GAP_YEARS = (1998, 1999)
POST_YEARS = (2000, 2001)
NORMAL_YEARS = PRE_YEARS + POST_YEARS
EXCLUDE_YEARS = GAP_YEARS
BASELINE_YEAR = 1997

PERIODS = {
    "Pre (1996-1997)": PRE_YEARS,
    "Gap (1998-1999)": GAP_YEARS,
    "Post (2000-2001)": POST_YEARS,
}

TRAIN_YEARS = (1996, 1997)
TEST_YEARS = (2000, 2001)
ROLLING_FOLDS = [((1996,), (1997,)), ((1996, 1997), (2000,)), ((1996, 1997, 2000), (2001,))]

CARRIER = "WN"
MIN_ROUTE_FLIGHTS = 100
MIN_AIRPORT_FLIGHTS = 1000
SEED = 42

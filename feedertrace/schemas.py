"""Schemas of all tables; nothing is inferred."""

from pyspark.sql import types as T

S, D, L, I, TS, DT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType(), T.DateType()


def _table(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


MEASUREMENTS = _table(badge=S, device_type=S, lat=D, lon=D, nominal=D, ts=TS, actual=D, pu=D)
BADGES = _table(badge=S, lat=D, lon=D, device_type=S, nominal=D)
SIGNATURES = _table(badge=S, signature=T.ArrayType(T.FloatType()))
CLUSTERS = _table(badge=S, cluster=L)
MAPPING = _table(badge=S, transformer=S)
PAIR_DAILY = _table(badge_a=S, badge_b=S, day=DT, r=D)
LEDGER = _table(badge_a=S, badge_b=S, values=T.ArrayType(D), historical_n=L, historical_mean=D, first_day=DT, last_day=DT)
RUNS = _table(run_id=S, run_date=S, n_badges=L, n_clusters=L, source=S)
PRESENCE = _table(badge=S, n_runs_seen=L, first_run=S, last_run=S)
CO_MEMBERSHIP = _table(badge_a=S, badge_b=S, times_together=L, first_together=S, last_together=S)
RECOMMENDATIONS = _table(badge=S, recommended=S, times_recommended=L, first_run=S, last_run=S)
IGNORED = _table(badge=S, recommended=S, date_added=S, notes=S)
#: Files of the asset register: all text.
SERVICE_POINTS = _table(**dict.fromkeys(("BADGENUMBER", "TRANSFORMERBANKOBJECTID", "TRANSBANKTAG", "CCBADDRESS1", "CCBCITY", "POINT_X", "POINT_Y", "FEEDERID", "d_FEEDERID"), S))
TRANSFORMERS = _table(**dict.fromkeys(("TAG", "STRUCTNO", "FEEDERID", "d_FEEDERID", "d_SUBTYPECD", "VAULTCD", "POINT_X", "POINT_Y", "TOTALKVA"), S))

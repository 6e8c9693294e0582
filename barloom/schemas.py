"""Column types of the price, listing and state tables. All numbers are doubles; a missing value is NULL, never NaN."""

from pyspark.sql import types as T

_D, _S, _L, _TS = T.DoubleType(), T.StringType(), T.LongType(), T.TimestampNTZType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


OHLCV = _schema(symbol=_S, time=_TS, open=_D, high=_D, low=_D, close=_D, volume=_L)
INDEX = _schema(time=_TS, open=_D, high=_D, low=_D, close=_D, volume=_L, change_percentage=_D)
BY_EXCHANGE = _schema(symbol=_S, exchange=_S, type=_S, organ_short_name=_S, organ_name=_S, product_grp_id=_S, icb_code2=_S)
BY_INDUSTRY = _schema(symbol=_S, organ_name=_S, icb_name2=_S, icb_name3=_S, icb_name4=_S, com_type_code=_S, icb_code1=_S, icb_code2=_S, icb_code3=_S, icb_code4=_S)
RAW_INDEX_CSV = _schema(time=_S, open=_S, high=_S, low=_S, close=_S, volume=_S, change_percentage=_S)
RSI_STATE = _schema(symbol=_S, time=_TS, rsi_14=_D, average_gain_14=_D, average_loss_14=_D)
ATR_STATE = _schema(symbol=_S, time=_TS, atr_14_w=_D)
RANKING = _schema(time=_TS, symbol=_S, alpha_score=_D)

"""Price bars derived from the driver's tables, by SQL that gives the same values in Spark and DuckDB.

Bars are not among the tables, so a symbol is a part brand and its price follows from the discounts of a day's lines.
All steps are whole numbers and prices are floored to cents: the views are equal bit by bit in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SHAPE = """
 greatest(open,close,floor(greatest(open,close)*(1e0+mx/400e0)*100e0)/100e0) as high,
 least(open,close,floor(least(open,close)*(1e0-mn/400e0)*100e0)/100e0) as low,
 close, volume"""
_STEP = """
    cast(floor(100e0*sum(cast(round(l_discount*100) as int)-5)/sqrt(cast(count(*) as double))) as bigint) as step,
    max(cast(round(l_tax*100) as int)) as mx, max(cast(round(l_discount*100) as int)) as mn,"""

OHLCV_SQL = f"""
select symbol, time, open,{_SHAPE}
from (
 select *, coalesce(lag(close) over (partition by symbol order by time), close) as open from (
  select *, floor(2000e0*exp(5e-5*sum(step) over (partition by symbol order by time
            rows between unbounded preceding and current row)))/100e0 as close from (
   select p_brand as symbol, l_shipdate + interval 7 hours as time,{_STEP}
    cast(floor(avg(l_quantity)*case when month(l_shipdate)%3=0 then 12000 else 48000 end) as bigint) as volume
   from lineitem join part on l_partkey=p_partkey group by p_brand, l_shipdate) a) b) c"""

INDEX_SQL = f"""
select time, open,{_SHAPE}, 100e0*(close/open-1e0) as change_percentage
from (
 select *, coalesce(lag(close) over (order by time), close) as open from (
  select *, floor(2000e0*exp(25e-6*sum(step) over (order by time
            rows between unbounded preceding and current row)))/100e0 as close from (
   select l_shipdate + interval 7 hours as time,{_STEP}
    cast(floor(avg(l_quantity)*40000) as bigint) as volume
   from lineitem group by l_shipdate) a) b) c"""

EXCHANGE_SQL = """select distinct p_brand as symbol,
 case when cast(substr(p_brand,7) as int) % 2 = 0 then 'HSX' else 'HNX' end as exchange from part"""

INDUSTRY_SQL = """select distinct p_brand as symbol,
 concat('Industry ', cast(cast(substr(p_brand,7) as int) % 4 as varchar(9))) as icb_name4 from part"""

RAW_CSV_SQL = """select * from (values
 ('02/01/2024','1,130.12','1,141.00','1,125.50','1,131.72','700.5M','0.16%'),
 ('03/01/2024',' 1,131.72 ','1,150.25','1,130.00','1,144.17','1.25B','1.10%'),
 ('04/01/2024','1,144.17','1,156.00','1,140.10','1,150.72','950k','-0.25%'),
 ('05/01/2024','1,150.72','1,158.00','1,148.00','1,154.68','-','0.34%')
) as t(time, open, high, low, close, volume, change_percentage)"""



def _padded(x: str, n: int) -> str:
    return f"lpad(cast({x} as varchar(20)),{n},'0')"


def _grouped(x: str) -> str:
    """A price in text: two decimals, a comma after the thousands."""
    whole, cents = f"cast(floor({x}) as bigint)", f"cast(round({x}*100e0) as bigint)%100"
    return f"concat(case when {x}>=1000e0 then concat(cast(cast(floor({x}/1000e0) as bigint) as varchar(20)),',',{_padded(f'{whole}%1000', 3)}) else cast({whole} as varchar(20)) end,'.',{_padded(cents, 2)})"


_VOLUME = f"""case day(time)%4
  when 0 then concat(cast(cast(floor(volume/1e3) as bigint) as varchar(20)),'k')
  when 1 then concat(cast(cast(floor(volume/1e6) as bigint) as varchar(20)),'.',{_padded('cast(floor(volume%1000000/1e3) as bigint)', 3)},'M')
  when 2 then concat(' 0.',{_padded('cast(floor(volume/1e6) as bigint)', 3)},'B ') else '-' end"""
_PERCENT = f"concat(case when change_percentage<0e0 then '-' else '' end,cast(cast(floor(abs(change_percentage)) as bigint) as varchar(20)),'.',{_padded('cast(floor(abs(change_percentage)*100e0) as bigint)%100', 2)},'%')"

#: The index as the text that its file holds: days, grouped prices, magnitudes with a suffix, shares in percent.
RAW_INDEX_SQL = f"""
select concat({_padded('day(time)', 2)},'/',{_padded('month(time)', 2)},'/',cast(year(time) as varchar(20))) as time,
 {_grouped('open')} as open, concat(' ',{_grouped('high')},' ') as high, {_grouped('low')} as low, {_grouped('close')} as close,
 {_VOLUME} as volume, {_PERCENT} as change_percentage
from ({INDEX_SQL}) i"""


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _bound(sql: str, *names: str) -> str:
    for n in names:
        sql = sql.replace(f"from {n} ", f"from {{{n}}} ").replace(f"join {n} ", f"join {{{n}}} ")
        sql = sql[: -len(n)] + f"{{{n}}}" if sql.endswith(f"from {n}") else sql
    return sql


def ohlcv_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of each symbol."""
    return spark.sql(_bound(OHLCV_SQL, "lineitem", "part"), **_tables(spark, sf_dir, "lineitem", "part"))


def vnindex_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the one index."""
    return spark.sql(_bound(INDEX_SQL, "lineitem"), **_tables(spark, sf_dir, "lineitem"))


def symbol_by_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_bound(EXCHANGE_SQL, "part"), **_tables(spark, sf_dir, "part"))


def symbol_by_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_bound(INDUSTRY_SQL, "part"), **_tables(spark, sf_dir, "part"))


def raw_index_csv(spark: SparkSession) -> DataFrame:
    return spark.sql(RAW_CSV_SQL)


def index_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived index as text, like the rows of its file."""
    return spark.sql(_bound(RAW_INDEX_SQL, "lineitem"), **_tables(spark, sf_dir, "lineitem"))

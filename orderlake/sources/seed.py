"""The exchange-rate seed (S4): 71 currencies, unique by code and by shop domain.

The seed rows are fixed values. The domain column holds the country suffix of the
shop's web address; the full domain is ``<shop_host>.<suffix>`` with the host name
given as a parameter (``DEFAULT_SHOP_HOST``), so one table serves any shop brand.
"""

from __future__ import annotations

import csv
import io
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

DEFAULT_SHOP_HOST = "shop"

RATES_SCHEMA = T.StructType([
    T.StructField("currency_code", T.StringType(), False),
    T.StructField("currency_name", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("rate_to_usd", T.DecimalType(12, 6), True),
    T.StructField("rate_from_usd", T.DecimalType(18, 6), True),
    T.StructField("domain", T.StringType(), True),
])

# currency_code, currency_name, symbol, rate_to_usd, rate_from_usd, domain suffix.
EXCHANGE_RATES_CSV = """\
USD,US Dollar,$,1.000000,1.000000,com
EUR,Euro,€,1.168872,0.855525,de
GBP,British Pound,£,1.342377,0.744947,co.uk
JPY,Japanese Yen,¥,0.006282,159.188728,co.jp
AUD,Australian Dollar,A$,0.707115,1.414196,com.au
CAD,Canadian Dollar,C$,0.723289,1.382572,ca
CHF,Swiss Franc,Fr,1.263733,0.791307,ch
CNY,Chinese Yuan Renminbi,¥,0.146391,6.831042,cn
HKD,Hong Kong Dollar,HK$,0.127649,7.833960,hk
SGD,Singapore Dollar,S$,0.785188,1.273580,sg
NZD,New Zealand Dollar,NZ$,0.584890,1.709723,co.nz
SEK,Swedish Krona,kr,0.107486,9.303533,se
NOK,Norwegian Krone,kr,0.105201,9.505609,no
DKK,Danish Krone,kr,0.156424,6.392896,dk
KRW,South Korean Won,₩,0.000677,1478.081673,co.kr
INR,Indian Rupee,₹,0.010810,92.503588,in
MYR,Malaysian Ringgit,RM,0.251214,3.980664,com.my
THB,Thai Baht,฿,0.031145,32.107685,co.th
PHP,Philippine Peso,₱,0.016746,59.716369,com.ph
IDR,Indonesian Rupiah,Rp,0.000059,17079.912089,co.id
TWD,Taiwan New Dollar,NT$,0.031449,31.797224,com.tw
VND,Vietnamese Dong,₫,0.000038,26230.000000,vn
BND,Bruneian Dollar,B$,0.785188,1.273580,com.bn
KWD,Kuwaiti Dinar,KD,3.240835,0.308562,com.kw
SAR,Saudi Arabian Riyal,SR,0.266667,3.750000,com.sa
AED,Emirati Dirham,AED,0.272294,3.672500,ae
QAR,Qatari Riyal,QR,0.274725,3.640000,com.qa
BHD,Bahraini Dinar,BD,2.659574,0.376000,com.bh
OMR,Omani Rial,RO,2.597980,0.384914,com.om
ILS,Israeli Shekel,₪,0.327280,3.055487,co.il
TRY,Turkish Lira,₺,0.022397,44.648674,com.tr
RUB,Russian Ruble,₽,0.012881,77.634453,ru
PLN,Polish Zloty,zł,0.275205,3.633657,pl
CZK,Czech Koruna,Kč,0.047956,20.852579,cz
HUF,Hungarian Forint,Ft,0.003102,322.375372,hu
RON,Romanian New Leu,lei,0.229545,4.356442,ro
ZAR,South African Rand,R,0.060897,16.421049,co.za
MXN,Mexican Peso,$,0.057529,17.382530,com.mx
BRL,Brazilian Real,R$,0.197133,5.072716,com.br
ARS,Argentine Peso,$,0.000723,1382.318748,com.ar
CLP,Chilean Peso,$,0.001119,893.523579,cl
COP,Colombian Peso,$,0.000274,3650.617142,com.co
PKR,Pakistani Rupee,₨,0.003584,279.013751,com.pk
LKR,Sri Lankan Rupee,Rs,0.003174,315.027952,lk
NPR,Nepalese Rupee,Rs,0.006753,148.075119,com.np
BDT,Bangladeshi Taka,৳,0.008700,114.943000,com.bd
KZT,Kazakhstani Tenge,₸,0.002095,477.338283,kz
IRR,Iranian Rial,﷼,0.000001,1315720.435912,ir
LYD,Libyan Dinar,LD,0.157234,6.359942,ly
MUR,Mauritian Rupee,Rs,0.021474,46.567728,mu
ISK,Icelandic Krona,kr,0.008153,122.660240,is
BWP,Botswana Pula,P,0.074477,13.426977,co.bw
TTD,Trinidadian Dollar,TT$,0.147521,6.778714,tt
EGP,Egyptian Pound,£,0.020380,49.067000,com.eg
NGN,Nigerian Naira,₦,0.000620,1612.900000,com.ng
GHS,Ghanaian Cedi,₵,0.064100,15.600000,com.gh
KES,Kenyan Shilling,KSh,0.007740,129.200000,co.ke
UAH,Ukrainian Hryvnia,₴,0.024100,41.494000,ua
HRK,Croatian Kuna,kn,0.132960,7.521000,hr
BGN,Bulgarian Lev,лв,0.551400,1.814300,bg
MAD,Moroccan Dirham,MAD,0.099700,10.030000,ma
JOD,Jordanian Dinar,JD,1.410000,0.709200,jo
BOB,Bolivian Boliviano,Bs,0.144718,6.91,com.bo
DOP,Dominican Peso,RD$,0.016529,60.5,com.do
PEN,Peruvian Sol,S/,0.289663,3.452293,pe
UYU,Uruguayan Peso,$U,0.022989,43.5,com.uy
CRC,Costa Rican Colon,₡,0.001887,530.0,co.cr
GTQ,Guatemalan Quetzal,Q,0.130378,7.67,com.gt
PYG,Paraguayan Guarani,₲,0.000155,6454.25,com.py
RSD,Serbian Dinar,din.,0.009901,101.0,rs
AZN,Azerbaijani Manat,₼,0.588235,1.700000,az
"""


def seed_rows(shop_host: str = DEFAULT_SHOP_HOST) -> list[tuple]:
    rows = []
    for rec in csv.reader(io.StringIO(EXCHANGE_RATES_CSV)):
        code, name, symbol, to_usd, from_usd, suffix = rec
        rows.append((code, name, symbol, Decimal(to_usd), Decimal(from_usd), f"{shop_host}.{suffix}"))
    return rows


def exchange_rates(spark: SparkSession, shop_host: str = DEFAULT_SHOP_HOST, path: str | None = None) -> DataFrame:
    """The seed as a DataFrame: read from a CSV with a header when ``path`` is given,
    else built from the fixed values above. They go in as an Arrow table, which Spark plans as
    a local relation of known size: a list of tuples would be an RDD of unknown size, and the
    other side of every join with it would be shuffled by a handful of currency codes."""
    if path is not None:
        return spark.read.schema(RATES_SCHEMA).option("header", True).csv(path)
    shape = to_arrow_schema(RATES_SCHEMA)
    columns = [pa.array(c, t) for c, t in zip(zip(*seed_rows(shop_host), strict=True), shape.types, strict=True)]
    return spark.createDataFrame(pa.table(columns, schema=shape), RATES_SCHEMA)


def seed_values_sql(shop_host: str = DEFAULT_SHOP_HOST) -> str:
    """The seed as a SQL VALUES list (for the SQL oracle)."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    vals = ",\n".join(
        f"({q(c)}, {q(n)}, {q(s)}, CAST('{a}' AS DECIMAL(12,6)), CAST('{b}' AS DECIMAL(18,6)), {q(d)})"
        for c, n, s, a, b, d in seed_rows(shop_host)
    )
    return (f"(SELECT * FROM (VALUES {vals}) AS t(currency_code, currency_name, symbol, "
            f"rate_to_usd, rate_from_usd, domain))")

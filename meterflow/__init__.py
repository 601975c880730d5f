"""meterflow: a PySpark-native metering and asset analytics engine.

Bronze meter feeds and asset master data are conformed into silver tables,
checked against data-quality rules, and turned into gold data products
(daily non-revenue water per district, asset failure features) plus the
report datasets built on them. Every operator is a function
``DataFrame(s) -> DataFrame`` built from Spark's own DataFrame API.
"""

__version__ = "0.1.0"

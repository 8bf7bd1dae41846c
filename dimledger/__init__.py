"""dimledger: Spark-native warehouse operators (SCD2 dimensions, high-water-mark
facts, point-in-time joins, category hierarchies, latest-per-key) and the
three daily reports composed from them (card fraud, stock/sales ABC feed,
promo-code state).

Every operator takes and returns a lazy ``DataFrame``; nothing is collected
to the driver except one-row values such as a watermark.
"""

__version__ = "0.1.0"

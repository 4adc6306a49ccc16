"""Decision-operations analytics on Spark.

Batch policy routing, staffing KPIs, segment / trend / queue reports, data
validation and cleaning, evaluation metrics and model dataflow, expressed as
DataFrame plans so Catalyst and AQE choose the physical strategy.
"""

__version__ = "0.1.0"

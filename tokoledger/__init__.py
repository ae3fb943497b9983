"""tokoledger -- retail rewards-programme analytics on Spark.

Operators (``tokoledger.operators``) are functions of DataFrames plus a
parameter object (``tokoledger.params``):

* activity quarter: ``activity.activity_sku_progress`` ... ``activity_incentive_summary`` (O1-O5)
* sales targets:    ``sales.basepack_lines``, ``basepack_sales_points``, ``growth_sales_points`` (O6, O7, O11)
* basepack:         ``basepack.basepack_detail``, ``basepack_summary``, ``invoice_distribution`` (O8-O10)
* growth:           ``growth.growth_achievement`` (O12)
* points:           ``points.point_ledger``, ``point_balance``, ``redeemed_by_outlet``,
                    ``injected_points_by_outlet`` (O13, O15, O16a)
* reports / views:  ``report.latest_address``, ``daily_outlet_report``, ``invoice_lines_view``,
                    ``invoice_headers_view`` (O14, O16-O18)
* redemption:       ``redeem.redemption_gate``, ``redemption_rows``, ``redemption_detail_rows``,
                    ``redemption_notifications`` (O19-O22)

Tables come from ``tokoledger.sources.tables`` (Parquet folder, catalog or
test stand-ins); ``tokoledger.plans.batches`` runs the reference's procedures
end to end into a sink; ``tokoledger.streaming`` runs redemption rounds as a
Structured Streaming job; ``python -m tokoledger`` is the command line.
"""

__version__ = "0.1.0"

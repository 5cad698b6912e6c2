"""seatmeter: usage-based billing analytics as Spark jobs.

Entry points:
* ``seatmeter.plans.daily_bill.Domain`` and its plans (``itemized``, ``subtenant_itemized``,
  ``mailbox_mart``, ``bill_bridge``): the daily bill for a run date.
* ``seatmeter.plans.daily_job.run_day``: every output of a run date, written day-replaced.
* ``seatmeter.streaming.incremental.run``: incremental snapshot loading with Structured Streaming.
* ``seatmeter.operators``: the individual operators (tree, peak selection, pricing, allowance,
  marts, bridge, CRM helpers, sinks), each a function of DataFrames and a run date.
"""

__version__ = "0.1.0"

"""regwise: agency-registry and public-notice analytics on Spark DataFrames.

Every public operator takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is executed eagerly except where a plan is cut with
``regwise.session.durable`` (a table written to the shared checkpoint folder).
"""

"""Behaviour analytics for a web shop on PySpark.

Batch reports over an action log (``plans``) and jobs over an ad-click stream
(``streaming``), built from DataFrame operators (``operators``, ``functions``)
and kept apart from where rows come from (``sources``) and go to (``sinks``).
"""

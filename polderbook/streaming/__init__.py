"""Streaming: nothing to add.

Loan tapes are dated snapshots, so there is no stateful stream operator.
Validation, rules and the AnaCredit mapping are stateless projections and run
unchanged on a streaming DataFrame (see ``tests/test_streaming.py``).
"""

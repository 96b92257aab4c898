"""The event stream: validation, first-seen dedup, late routing and five-minute windows.

:mod:`.rules` has them as plain expressions and queries; :mod:`.live` runs the same
ones on Structured Streaming.
"""

"""The registered queries; importing any of these modules registers all."""

from atrium.plans import answers, detections, events, frames, housekeeping, identity, ledgers, merging, quality, relational, reports, scenes, scoring, settings, streams, venue  # noqa: F401
from atrium.plans import summaries  # noqa: F401,E402  (composes the queries above)

"""Imports every query module, so that each registers its queries."""

from gleanworks.plans import audit, collection, configuration, curation, evaluation, learning, pictures, sampling, streams  # noqa: F401

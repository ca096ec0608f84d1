"""Scheduled, personalised outreach as Spark jobs.

``plans`` holds the user-level pipelines, ``operators`` the reusable DataFrame
operators they are made of, ``functions`` the column expressions, ``sources``
the schemas, ledgers and files, and ``streaming`` the incremental mailing.
"""

from muster.config import MailingConfig

__all__ = ["MailingConfig"]

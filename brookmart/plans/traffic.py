"""Traffic: cleaned logs and the windows over page records."""
from __future__ import annotations

from brookmart.functions.text import split_keyword
from brookmart.operators import windows
from brookmart.operators.logs import fix_is_new, pages, parse_log, search_events, split_dirty, split_log


def clean_log(df_text):
    """Well-formed log records."""
    return split_dirty(parse_log(df_text))[0]


def cleaned_log(df_text):
    """Well-formed log records with a repaired new-visitor mark."""
    clean, _ = split_dirty(parse_log(df_text))
    return fix_is_new(clean)


def split_logs(df_text):
    """All outputs of the log job: dirty, err, start, page, display, action."""
    clean, dirty = split_dirty(parse_log(df_text))
    return {"dirty": dirty, **split_log(fix_is_new(clean))}


def traffic_window(page_log, seconds=10, **options):
    """Visitors, sessions, views and time by version, channel, area and is_new."""
    return windows.traffic_window(pages(page_log), seconds, **options)


def home_detail_window(page_log, seconds=10, **options):
    """Unique visitors of the home page and of product pages."""
    return windows.home_detail_window(pages(page_log), seconds, **options)


def keyword_window(page_log, seconds=5, segmenter=None):
    """Search words per window."""
    def split(rows):
        return split_keyword(rows, "item", segmenter=segmenter)
    events = search_events(page_log)
    if events.isStreaming:
        return windows.keyword_window(split(events), seconds)
    return windows.text_window(events, split, seconds)

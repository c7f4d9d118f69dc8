"""Operators for preparing training data: crawl archives, languages, chats, pages, duplicates, toxicity, tokens."""

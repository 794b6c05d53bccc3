"""Sources: driver tables, derived event views, file/rate streams and connector option sets."""

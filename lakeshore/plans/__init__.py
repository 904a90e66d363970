"""Physical-side helpers: size-checked joins, storage, export, the daily flow."""

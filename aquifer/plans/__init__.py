"""Plans: raw documents to bronze, silver, joined models, marts and live views."""

"""DataFrame-to-DataFrame operators. Import them from their modules."""

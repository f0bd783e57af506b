"""Monthly jobs: panels, scoring, publishing, back-fill."""

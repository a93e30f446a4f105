"""admitlab.sources."""

"""Report jobs. Each public function returns a lazy DataFrame."""
